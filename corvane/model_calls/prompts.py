"""Prompt files and their rendering."""

from __future__ import annotations

import json
import re
from pathlib import Path

SPLIT = "---USER---"
FIELD = re.compile(r"\{\{\s*([\w.]+)\s*\}\}")


def prompt_path(folder: str, name: str, version: str) -> Path:
    path = Path(folder) / f"{name}_{version}.md"
    if not path.is_file():
        raise FileNotFoundError(path)
    return path


def prompt_versions(folder: str, name: str) -> list[str]:
    return sorted(p.stem.removeprefix(f"{name}_") for p in Path(folder).glob(f"{name}_*.md"))


def strip_header(text: str) -> str:
    """Text without front matter."""
    return re.sub(r"\A---\n.*?\n---\n?", "", text, flags=re.S)


def few_shot_block(examples: list[dict]) -> str:
    return "\n\n".join(f"Example {i}\nInput: {json.dumps(e['input'], sort_keys=True)}\nOutput: {json.dumps(e['output'], sort_keys=True)}" for i, e in enumerate(examples, 1))


def render(text: str, variables: dict, examples: list[dict] | None = None, schema: dict | None = None) -> tuple[str, str]:
    """(system, user) parts. A variable that is not given is an error; examples go before the user part; a schema adds
    the demand for JSON."""

    def value(m: re.Match) -> str:
        if m.group(1) not in variables:
            raise KeyError(f"prompt variable {m.group(1)} is not given")
        return str(variables[m.group(1)])

    body = strip_header(text)
    system, _, user = body.partition(SPLIT)
    if not _:
        system, user = "", body
    if examples:
        system = f"{system.rstrip()}\n\n{few_shot_block(examples)}\n"
    user = FIELD.sub(value, user)
    if schema:
        user += "\n\nAnswer with one JSON object of this shape only: " + json.dumps(schema, sort_keys=True)
    return FIELD.sub(value, system).strip(), user.strip()
