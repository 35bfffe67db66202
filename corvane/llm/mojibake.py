"""Garbled text from wrong character encoding.

Each passage (sentence or line) that holds characters beyond ASCII, or character entities, goes through a best-first
search. A state is a text; operations encode it in one encoding and decode the bytes in another, or resolve character
entities; visited texts are remembered by hash. A state's total is the cost of its path plus a plausibility cost of its
characters, and the search follows the cheapest total until nothing cheaper can be reached; texts whose total is four times
that of the passage and more (and 12 besides) are not followed. It ends, as every step but one re-coding between single-byte
encodings makes the text shorter. A passage is garbled if the
cheapest text was reached by re-coding and is cheaper than the passage itself, or if it holds traces that no re-coding
explains (lost characters, control characters, symbols inside words). As a passage may mix sound and garbled words, the
search is repeated word by word, whatever the passage around a word costs.

The plausibility cost knows classes of characters and their neighbours (case, script, symbols inside words), not words of
any language, so it is the same at every size and for every corpus. What is left after the search counts by its traces
alone, not by its letters, so text in any script, with or without blanks, is sound.
"""

from __future__ import annotations

import codecs
import heapq
import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

#: Encodings UTF-8 bytes may have been read in, and pairs (read in, written in) of single-byte encodings. Decoding as
#: UTF-8 proves itself; a change between single-byte encodings always works, so it must earn a higher cost and may occur
#: once in a path.
READ_AS = ("cp1252", "mac_roman", "cp437", "cp1250", "cp1251", "koi8_r", "cp850", "iso8859_2", "cp866", "mac_cyrillic")
PAIRS = (
    ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1252", "cp437"), ("cp1252", "cp850"),
    ("cp1250", "cp1252"), ("cp1252", "cp1250"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp1252", "cp1251"), ("cp1252", "koi8_r"),
    ("cp1251", "cp1252"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("cp1252", "cp866"), ("mac_cyrillic", "cp1251"), ("mac_roman", "cp1251"),
    ("cp437", "cp1251"), ("koi8_r", "cp866"), ("cp866", "koi8_r"),
)
UTF8_COST, BYTE_COST, ENTITY_COST = 1.0, 2.5, 0.5

PASSAGE = re.compile(r"(?<=[.!?…])[ \t]+|\n+")
ENTITY = re.compile(r"&(?:#\d{2,6}|#x[0-9a-fA-F]{2,5}|[A-Za-z]{2,8});")
#: A character lost while decoding: the mark that stands for one, or a question mark after a letter and before a symbol that
#: no sentence has there (the second half of a broken character). Closing quotes and opening ¿ ¡ may follow a question.
LOST = re.compile(r"�|[^\W\d_]\?[\x80-\x9f¢-ª¬-º¼-¾‚„†‡‰€™](?!\w*\?)|(?<![\w?])\?[¨-ª¬-º¼-¾][a-z]|[a-z]\?[¡¿][a-z]|\?€[”™“œ˜¦¢\x9d]")


#: What may be a lost character: a question mark beside one beyond ASCII. Too weak to call a text garbled.
HOLE = re.compile(r"[\x80-\xff‚-™]\?|\?[\x80-\xff‚-™]")


@lru_cache(maxsize=32)
def _table(codec: str) -> tuple[str, dict[int, int]]:
    """Characters of the 256 bytes (undefined ones as control characters) and the way back."""
    chars = []
    for b in range(256):
        try:
            chars.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            chars.append(chr(b))
    back = {ord(c): b for b, c in reversed(list(enumerate(chars)))}
    if codec == "cp1252":
        back |= {b: b for b in range(0x80, 0xA0)}
    return "".join(chars), back


def _encode(text: str, codec: str) -> bytes | None:
    try:
        return codecs.charmap_encode(text, "strict", _table(codec)[1])[0]
    except UnicodeEncodeError:
        return None


def _decode(data: bytes, codec: str) -> str | None:
    try:
        return data.decode("utf-8") if codec == "utf-8" else codecs.charmap_decode(data, "strict", _table(codec)[0])[0]
    except UnicodeDecodeError:
        return None


#: Letters of the Western European languages, punctuation of running text, symbols next to numbers.
COMMON = frozenset("áéíóúýàèìòùâêîôûäëïöüãõñçåæøœßþð")
MARKS = frozenset("’‘“”„«»–—…‐‑•")
SYMBOLS = frozenset("№€£¥°±µμ²³¹½¼¾×÷§©®™¿¡ºª₀₁₂₃₄₅₆₇₈₉†‡‰→≥≤≈∞≠")
#: Russian letters from frequent to rare.
CYRILLIC = {c: w for w, letters in ((0.05, "оеаинтсрвлкмдпу"), (0.3, "яыьгзбчйхжш"), (0.7, "юцщэфъё")) for c in letters}


@lru_cache(maxsize=20_000)
def _kind(c: str) -> str:
    """Class of a character: see ``plausibility``."""
    o = ord(c)
    if o < 128:
        return "a" if c.islower() else "A" if c.isupper() else "d" if c.isdigit() else "p"
    if c == "�":
        return "f"
    if o < 0xA0:
        return "z"
    if c == "\xa0" or c == " ":
        return "p"
    if c == "\xad":
        return "h"
    if c in MARKS:
        return "q"
    if c in SYMBOLS:
        return "s"
    low = c.lower()
    name = unicodedata.name(c, "")
    if name.startswith("LATIN") and c.isalpha() and "LIGATURE F" not in name and c != "ƒ":
        return ("l" if low in COMMON else "x") if c.islower() else ("L" if low in COMMON else "X") if c.isupper() else "s"
    if name.startswith("CYRILLIC"):
        return ("c" if c.islower() else "C") if low in CYRILLIC else ("k" if c.islower() else "K")
    if name.startswith("GREEK"):
        return "g"
    if "BOX DRAWINGS" in name or 0x2580 <= o < 0x25A0 or o == 0x2310:
        return "b"
    if c.isalpha() and not name.startswith("MODIFIER"):
        return "o"
    kind = unicodedata.category(c)
    if kind[0] == "M":
        return "m"
    if o >= 0x2E80:
        return "e"
    if kind == "Cf":
        return "h"
    return "n" if kind == "Nd" or (kind[0] == "P" and not 0x2000 <= o < 0x2070) else "w"


LETTERS = frozenset("aAlLxXcCkKgo")
LOWER, UPPER = frozenset("alxck"), frozenset("ALXCK")
LATIN, SLAVIC = frozenset("aAlLxX"), frozenset("cCkK")


def weigh(text: str) -> tuple[float, float]:
    """Cost of the characters of a text, and the part of it that is due to traces of a wrong encoding. Letters cost little: less
    where they are common in their script; where they stand costs 1.5 or more if no script would have it so. Every script
    has letters, marks, digits and punctuation of its own; symbols are a trace only beside letters."""
    entities = 2.5 * len(ENTITY.findall(text)) if "&" in text else 0.0
    if text.isascii():
        return entities, 0.0
    kinds = [_kind(c) for c in text]
    cost, traces, run, last = 0.0, 0.0, 0, len(kinds) - 1
    for i, k in enumerate(kinds):
        if k in "aAdp":
            run = 0
            continue
        before = kinds[i - 1] if i else "p"
        after = kinds[i + 1] if i < last else "p"
        trace = 0.0
        if k in "lxLX":
            run += 1
            cost += {"l": 0.3, "x": 0.8, "L": 0.5, "X": 1.0}[k]
            if run > 2:
                cost += 1.5
            if before in SLAVIC or after in SLAVIC:
                trace += 3
            if k in "lx":
                if after in "ALX":
                    trace += 3
            else:
                if before in LOWER:
                    trace += 4
                elif after in "swbgzmf" or (after == "q" and text[i + 1] not in "’”»…–—"):
                    trace += 3
                elif text[i] in "ÃÂ" and before not in LETTERS and after not in LETTERS:
                    trace += 2.5
            cost, traces = cost + trace, traces + trace
            continue
        run = 0
        if k in "cC":
            cost += CYRILLIC[text[i].lower()]
            if k == "C" and before in LETTERS:
                if before in LOWER:
                    trace += 4
                else:
                    cost += 0.15
            if before in LATIN or after in LATIN:
                trace += 3
        elif k in "kK":
            cost += 1.5
            trace += 3 if before in LATIN or after in LATIN or (k == "K" and before in LOWER) else 0
        elif k == "q":
            inside = before in LETTERS and after in LETTERS
            if before in LETTERS and text[i] == "„":  # „ only opens
                trace += 3
            elif not inside or text[i] in "’‑–—" or "o" in (before, after):
                cost += 0.2
            else:
                trace += 3
            if before in "swb" or after in "swb":
                trace += 1.5
        elif k == "s":
            if before in LETTERS and after in LETTERS:
                trace += 3
            elif before in LETTERS and text[i] not in "²³¹₀₁₂₃₄₅₆₇₈₉®™ºª°":
                trace += 3
            elif after in LETTERS and text[i] in "¼½¾²³¹©™†‡‰≥≤≈∞≠×÷§":
                trace += 3
            else:
                cost += 0.3
        elif k == "g":
            cost += 0.4
            trace += 3 if before in LATIN or after in LATIN or after in "swb" else 0
        elif k == "h":
            cost += 0.5
        elif k == "w":
            beside = before in LETTERS or after in LETTERS
            cost += 0 if beside else 3.5
            trace += 4.5 if before in LETTERS and after in LETTERS else 3.5 if beside else 0
        elif k == "b":
            trace += 4
        elif k in "zf":
            trace += 6
        elif k == "m":
            cost += 0.5
            trace += 1.5 if before in "aAlLxXdps" and after in "lLxXsw" else 0
        elif k == "n":
            cost += 0.3
            trace += 3 if before in LATIN and after in LATIN else 0
        else:
            cost += 0.3
        cost, traces = cost + trace, traces + trace
    return cost + entities, traces


def plausibility(text: str) -> float:
    """Cost of the characters of a text; about 0.3 an accented letter in sound text, 3 or more for each trace of a wrong
    encoding."""
    return weigh(text)[0]


def _steps(text: str, byte_steps: bool) -> Iterator[tuple[str, float, str]]:
    """Texts one operation away."""
    if "&" in text and (plain := html.unescape(text)) != text:
        yield plain, ENTITY_COST, "unescape"
    if text.isascii():
        return
    for source in READ_AS:
        data = _encode(text, source)
        if data is None:
            continue
        if (found := _decode(data, "utf-8")) is not None and found != text:
            yield found, UTF8_COST, f"{source}>utf-8"
    if byte_steps:
        for source, target in PAIRS:
            data = _encode(text, source)
            if data is not None and (found := _decode(data, target)) is not None and found != text:
                yield found, BYTE_COST, f"{source}>{target}"


def search(text: str, byte_steps: bool = True) -> tuple[str, str, float]:
    """Cheapest reachable text, the path to it (empty for the text itself) and what it saves."""
    own = plausibility(text)
    best, best_path, best_total = text, (), own
    heap = [(own, 0, 0.0, text, ())]
    seen = {hash(text)}
    count = 0
    while heap:
        total, _, spent, state, path = heapq.heappop(heap)
        if total > 4 * own + 12 or spent + UTF8_COST * 0.5 >= best_total:
            continue
        for found, price, name in _steps(state, byte_steps and all(p == "unescape" or p.endswith(">utf-8") for p in path)):
            if hash(found) in seen:
                continue
            seen.add(hash(found))
            count += 1
            cost = spent + price
            full = cost + plausibility(found)
            if full < best_total:
                best, best_path, best_total = found, (*path, name), full
            if full < 4 * own + 12:
                heapq.heappush(heap, (full, count, cost, found, (*path, name)))
    return best, " ".join(best_path), own - best_total


@dataclass
class Finding:
    """A text's restored form, the operations used, and whether traces are left that nothing restores."""

    text: str
    garbled: bool
    path: str
    n_passages: int
    lossy: bool


#: What a re-coding must save.
MARGIN = 0.5
#: No text of a lower cost can be re-coded with that saving.
LEAST = UTF8_COST + MARGIN


def _recoded(path: str) -> bool:
    return ">" in path


def _chunks(passage: str, most: int = 2000) -> list[str]:
    """A passage in parts of at most ``most`` characters, cut at blanks where there are some: the whole passage is searched,
    part by part."""
    parts = []
    while len(passage) > most:
        at = passage.rfind(" ", most // 2, most) + 1 or most
        parts.append(passage[:at])
        passage = passage[at:]
    return [*parts, passage]


class Restorer:
    """Searches passages and remembers them, up to ``memory`` of them."""

    def __init__(self, memory: int = 200_000):
        self.memory = memory
        self.known: dict[str, tuple[str, str, float, bool]] = {}

    def _passage(self, passage: str) -> tuple[str, str, bool]:
        """Restored passage, path, and whether traces are left."""
        if (known := self.known.get(passage)) is None:
            if len(self.known) >= self.memory:
                self.known.clear()
            known = self.known[passage] = self._search(passage)
        return known

    def _search(self, passage: str) -> tuple[str, str, bool]:
        own = plausibility(passage)
        words = re.split(r"([ \t]+)", passage)
        odd = [i for i, w in enumerate(words) if not w.isascii() or ENTITY.search(w)]
        if own < LEAST or not odd:
            return passage, "", False
        paths: list[str] = []
        whole = not (LOST.search(passage) or HOLE.search(passage))  # where characters are lost, only UTF-8 proves a restoration
        joined = " ".join(words[i] for i in odd)
        text, path, gain = search(joined, whole)
        if path and gain >= MARGIN and len(parts := text.split(" ")) == len(odd):
            paths.append(path)
            for i, w in zip(odd, parts):
                words[i] = w
        for i in odd:
            if plausibility(words[i]) >= LEAST:
                pieces = re.split("([\ufffd?]+)", words[i])  # what is lost splits a word
                for k in range(0, len(pieces), 2):
                    text, path, gain = search(pieces[k], whole)
                    if path and gain >= MARGIN:
                        pieces[k] = text
                        paths.append(path)
                words[i] = "".join(pieces)
        left = sum(t for i in odd if (t := weigh(words[i])[1]) >= 4)
        return "".join(words), " | ".join(dict.fromkeys(paths)), left >= 4

    def restore(self, text: str | None) -> Finding | None:
        """None where nothing is garbled."""
        if not text or (text.isascii() and "&" not in text):
            return None
        spans, at = [], 0
        for m in PASSAGE.finditer(text):
            spans += [(text[at : m.start()], True), (m.group(), False)]
            at = m.end()
        spans.append((text[at:], True))
        spans = [(part, is_passage) for span, is_passage in spans for part in (_chunks(span) if is_passage else [span])]
        out, paths, n, left = [], [], 0, False
        for span, is_passage in spans:
            if is_passage and not (span.isascii() and "&" not in span):
                span, path, traces = self._passage(span)
                left |= traces
                if _recoded(path):
                    n += 1
                    paths.append(path)
            out.append(span)
        lossy = bool(LOST.search(text)) or left
        if not paths and not lossy:
            return None
        return Finding("".join(out), True, " | ".join(dict.fromkeys(paths)), n, lossy)


def find_garbled(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_id, restored, path, n_passages, lossy) of every garbled document, from whole texts. NULL, empty and sound texts
    give no row; ``lossy`` is true where characters are lost or traces are left. Other columns are ignored."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer()
        for batch in batches:
            rows = []
            for key, t in zip(batch[row_id], batch[text]):
                found = restorer.restore(t if isinstance(t, str) else None)
                if found:
                    rows.append((key, found.text, found.path, found.n_passages, found.lossy))
            yield pd.DataFrame(rows, columns=[row_id, "restored", "path", "n_passages", "lossy"])

    kind = docs.schema[row_id].dataType.simpleString()
    return docs.select(row_id, text).mapInPandas(run, f"{row_id} {kind}, restored string, path string, n_passages int, lossy boolean")
