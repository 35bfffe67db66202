"""Providers: what answers a prompt. The default is offline and deterministic; a network provider is wrapped with retries."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol


@dataclass
class Answer:
    text: str
    n_in: int
    n_out: int


class Provider(Protocol):
    def ask(self, system: str, user: str, max_tokens: int) -> Answer: ...


class Retryable(Exception):
    """A failure worth another attempt: rate limit, connection, server error."""


def with_retries(call: Callable[[], Answer], attempts: int = 5, first: float = 4.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> Answer:
    """Exponential waits between attempts; other failures pass through at once."""
    for i in range(attempts):
        try:
            return call()
        except Retryable:
            if i == attempts - 1:
                raise
            sleep(min(most, first * 2**i))
    raise AssertionError


class KeywordProvider:
    """Picks the label whose keywords occur most in the prompt; ties go to the first label. Offline, so a pipeline can run
    and be tested anywhere."""

    def __init__(self, labels: dict[str, list[str]], other: str = "unknown"):
        self.labels, self.other = labels, other

    def ask(self, system: str, user: str, max_tokens: int) -> Answer:
        text = user.lower()
        counts = [(sum(text.count(w) for w in words), name) for name, words in self.labels.items()]
        best = max(counts, key=lambda x: x[0], default=(0, self.other))
        label = best[1] if best[0] else self.other
        body = json.dumps({"label": label, "confidence": "HIGH" if best[0] > 1 else "LOW", "hits": best[0]})
        return Answer(body, (len(system) + len(user)) // 4, max_tokens // 3)


def parse_answer(text: str) -> dict | None:
    """The JSON object of an answer, with or without a code fence; None if there is none."""
    body = re.sub(r"^```[a-zA-Z]*\s*|\s*```$", "", text.strip())
    try:
        value = json.loads(body)
    except ValueError:
        return None
    return value if isinstance(value, dict) else None
