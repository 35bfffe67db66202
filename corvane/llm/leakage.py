"""Evaluation texts leaking into training text.

A word that is a number, a unit or a name is replaced by a typed placeholder; what stays is the template. Names are
told by the evaluation items themselves: a word that few items share is a name. A template is thus a function of the
words alone, so equal passages have equal templates whatever their case or layout. Windows of ``window`` words are
hashed by their template and joined; then the slots (the words behind the placeholders) are checked: equal slots are
a verbatim leak, a one-to-one renaming of slots over many aligned windows is a re-parameterised question.

Windows of the corpus whose template hash no item has are dropped in the scan, by a sorted array of the items' hashes.
Its size is checked; beyond ``filter_bound`` hashes all windows go into the join. Nothing about documents is collected.

NULL, empty and short texts have no windows and so no rows; very long texts are read whole; a document or item that occurs
twice counts once; without documents or items the results are empty; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.scratch import Scratch

WORD = re.compile(r"[^\W_]+")
#: Units of measure that become a placeholder.
UNITS = frozenset("kw mw gw kwh mwh gwh km m cm mm kg g t lb ft mi s ms min h hr hrs kpa mpa bar psi k c f v a hz usd eur gbp percent pct ppm".split())
NUMBER, UNIT, NAME = "\x01", "\x02", "\x03"
MULTIPLIER = 0x9E3779B97F4A7C15


def words_of(text: str) -> list[str]:
    """Maximal runs of letters and digits, lower-case."""
    return WORD.findall(text.lower())


def placeholder(word: str, vocabulary: frozenset[str]) -> str:
    """The word in a template: itself if the items share it, else its type."""
    if any(c.isdigit() for c in word):
        return NUMBER
    if word in UNITS:
        return UNIT
    return word if word in vocabulary else NAME


def _code(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


class Windows:
    """Template windows of texts; words are typed and coded once and remembered, up to ``memory`` words."""

    def __init__(self, vocabulary: frozenset[str], window: int, memory: int = 500_000):
        self.vocabulary, self.window, self.memory = vocabulary, window, memory
        self.known: dict[str, tuple[int, bool]] = {}
        powers = [1]
        for _ in range(window - 1):
            powers.append(powers[-1] * MULTIPLIER % 2**64)
        self.powers = np.array(powers, dtype=np.uint64)

    def _typed(self, word: str) -> tuple[int, bool]:
        if (known := self.known.get(word)) is None:
            if len(self.known) >= self.memory:
                self.known.clear()
            p = placeholder(word, self.vocabulary)
            known = self.known[word] = (_code(p), p in (NUMBER, UNIT, NAME))
        return known

    def of(self, text: str, wanted: np.ndarray | None) -> tuple[list[str], list[bool], np.ndarray, np.ndarray]:
        """Words, which of them are slots, and positions and template hashes of the windows that are wanted."""
        words = words_of(text)
        if len(words) < self.window:
            return words, [], np.empty(0, np.int64), np.empty(0, np.int64)
        typed = [self._typed(w) for w in words]
        codes = np.fromiter((c for c, _ in typed), np.uint64, len(typed))
        with np.errstate(over="ignore"):
            hashes = (np.lib.stride_tricks.sliding_window_view(codes, self.window) * self.powers).sum(axis=1, dtype=np.uint64).view(np.int64)
        if wanted is None:
            at = np.arange(len(hashes))
        elif len(wanted):
            spot = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
            at = np.flatnonzero(wanted[spot] == hashes)
        else:
            at = np.empty(0, np.int64)
        return words, [s for _, s in typed], at, hashes[at]


def template_windows(df: DataFrame, row_id: str, text: str, vocabulary: frozenset[str], window: int, wanted: np.ndarray | None = None) -> DataFrame:
    """(row_id, position, template, slots) of the windows of every whole text; NULL and short texts have none."""
    shared = df.sparkSession.sparkContext.broadcast((vocabulary, wanted))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, wanted = shared.value
        windows = Windows(vocabulary, window)
        for batch in batches:
            rows = []
            for key, t in zip(batch[row_id], batch[text]):
                if not isinstance(t, str):
                    continue
                words, slots, at, hashes = windows.of(t, wanted)
                for i, h in zip(at.tolist(), hashes.tolist()):
                    rows.append((key, i, h, " ".join(w for w, s in zip(words[i : i + window], slots[i : i + window]) if s)))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=[row_id, "position", "template", "slots"])
                    rows = []
            yield pd.DataFrame(rows, columns=[row_id, "position", "template", "slots"])

    kind = df.schema[row_id].dataType.simpleString()
    return df.select(row_id, text).mapInPandas(run, f"{row_id} {kind}, position int, template bigint, slots string")


class Leaks:
    """Documents and items joined by template windows. ``verbatim`` and ``reparameterised`` are lazy."""

    def __init__(self, docs: DataFrame, items: DataFrame, *, window: int = 13, shared_by: float = 0.01, filter_bound: int = 2_000_000):
        scratch = Scratch(docs.sparkSession)
        self.window = window
        items = items.select("item_id", "text").where(F.col("text").isNotNull())
        n = items.count()
        tokens = items.select("item_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))).alias("w"))
        #: At most 1 / shared_by times the words of an item: bounded by the length of an item, not by their number.
        common = tokens.groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= max(3, shared_by * n))
        vocabulary = frozenset(r.w for r in common.select("w").collect())
        self.items = scratch.keep(template_windows(items, "item_id", "text", vocabulary, window))
        hashes = self.items.select("template").distinct()
        few = hashes.limit(filter_bound + 1).toPandas()["template"].to_numpy(dtype=np.int64)
        wanted = np.sort(few) if len(few) <= filter_bound else None
        self.docs = scratch.keep(template_windows(docs.select("doc_id", "text"), "doc_id", "text", vocabulary, window, wanted))

    def verbatim(self) -> DataFrame:
        """(doc_id, item_id): at least one window of equal template and equal slots, that is, of equal words."""
        a = self.docs.select("doc_id", "template", "slots").distinct()
        b = self.items.select("item_id", "template", "slots").distinct()
        return a.join(b, ["template", "slots"]).select("doc_id", "item_id").distinct()

    def reparameterised(self, cover: float = 0.5, least_fixed: int = 4) -> DataFrame:
        """(doc_id, item_id, n_windows, n_slots, n_changed): the document holds, in one alignment, ``cover`` or more of the
        item's windows by template, with slots renamed one to one and at least one of them changed. Only windows with
        ``least_fixed`` words that are no slots count, on both sides: a template of hardly anything but slots says nothing
        and would be met everywhere. The sets gathered are bounded by the item's own length."""
        slots = F.when(F.col("slots") == "", 0).otherwise(F.size(F.split("slots", " ")))
        docs, items = self.docs.where(self.window - slots >= least_fixed), self.items.where(self.window - slots >= least_fixed)
        sizes = items.groupBy("item_id").agg(F.count("*").alias("size"))
        pairs = docs.join(items.select("item_id", F.col("position").alias("at"), "template", F.col("slots").alias("own")), "template")
        pairs = pairs.withColumn("shift", F.col("position") - F.col("at"))
        aligned = pairs.groupBy("doc_id", "item_id", "shift").agg(F.count("*").alias("n_windows"), F.collect_set(F.struct("own", "slots")).alias("seen"))
        zipped = F.array_distinct(F.flatten(F.transform("seen", lambda s: F.arrays_zip(F.split(s["own"], " ").alias("x"), F.split(s["slots"], " ").alias("y")))))
        out = aligned.join(sizes, "item_id").where(F.col("n_windows") >= F.col("size") * cover).withColumn("map", zipped)
        count = lambda part: F.size(F.array_distinct(F.transform("map", lambda p: p[part])))
        out = out.withColumn("n_slots", F.size("map")).withColumn("n_changed", F.size(F.filter("map", lambda p: p["x"] != p["y"])))
        out = out.where((count("x") == F.col("n_slots")) & (count("y") == F.col("n_slots")) & (F.col("n_changed") > 0))
        return out.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_windows", "n_slots", "n_changed")).alias("r")).select("doc_id", "item_id", "r.*")
