"""Similarity of names."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_tokens(x: Column) -> Column:
    """Words in order, joined by single spaces."""
    return F.array_join(F.array_sort(F.split(F.trim(F.regexp_replace(x, r"\s+", " ")), " ")), " ")


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, row by row of the dynamic programme, without Python."""
    chars_b = F.filter(F.split(b, ""), lambda x: x != "")
    zero = F.transform(chars_b, lambda x: F.lit(0))

    def step(row: Column, x: Column) -> Column:
        cells = F.arrays_zip(chars_b.alias("ch"), row.alias("up"), F.concat(F.array(F.lit(0)), F.slice(row, F.lit(1), F.greatest(F.size(row) - 1, F.lit(0)))).alias("diag"))
        return F.aggregate(
            cells,
            F.slice(row, F.lit(1), F.lit(0)),
            lambda done, cell: F.concat(done, F.array(F.when(cell["ch"] == x, cell["diag"] + 1).otherwise(F.greatest(cell["up"], F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)))))),
        )

    last = F.aggregate(F.filter(F.split(a, ""), lambda x: x != ""), zero, step)
    return F.coalesce(F.array_max(last), F.lit(0))


def indel_ratio(a: Column | str, b: Column | str) -> Column:
    """200 LCS / (length a + length b); 0 for two empty texts. The LCS is found with bit rows, a bit a character."""

    @F.pandas_udf("double")
    def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_indel(x, y) for x, y in zip(a, b)], dtype="float64")

    return ratios(a, b)


def _indel(x: str | None, y: str | None) -> float | None:
    if x is None or y is None:
        return None
    if not x and not y:
        return 0.0
    masks: dict[str, int] = {}
    for i, ch in enumerate(x):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << len(x)) - 1
    s = full
    for ch in y:
        u = s & masks.get(ch, 0)
        s = ((s + u) | (s - u)) & full
    return 200.0 * (len(x) - s.bit_count()) / (len(x) + len(y))


def may_reach(a: Column, b: Column, threshold: float) -> Column:
    """Necessary condition for ``indel_ratio`` to reach ``threshold``, by lengths and a bounded edit distance; JVM-side."""
    total = F.length(a) + F.length(b)
    return (200 * F.least(F.length(a), F.length(b)) >= threshold * total) & (F.levenshtein(a, b) <= (1 - threshold / 100) * total)


def gestalt_ratio(a: Column | str, b: Column | str) -> Column:
    """Ratcliff-Obershelp ratio of two texts."""

    @F.pandas_udf("double")
    def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")

    return ratios(a, b)
