"""The prompts of the package: one file a name and version in ``texts``, read on the driver."""

from __future__ import annotations

from pathlib import Path

from corvane.model_calls.prompts import prompt_path, prompt_versions, strip_header

FOLDER = str(Path(__file__).parent / "texts")


def versions(name: str) -> list[str]:
    """Versions of a prompt, in order."""
    return prompt_versions(FOLDER, name)


def prompt_text(name: str, version: str) -> str:
    """Text of a prompt without its front matter; an error if there is no such file."""
    return strip_header(prompt_path(FOLDER, name, version).read_text(encoding="utf-8")).strip()
