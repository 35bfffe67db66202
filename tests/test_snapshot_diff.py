"""Snapshot differences: cases, nulls, repetitions, gaps, and a brute-force comparison."""

import random

from pyspark.sql import functions as F

from corvane.operators.snapshot_diff import as_set, snapshot_changes, tidy

SCHEMA = "id long, v int, s string, k string, name string, tags string, change string"


def changes(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    out = snapshot_changes(df.where("k is not null"), keys={"s": F.col("s"), "k": F.lower(F.trim("k"))}, fields=[tidy(F.col("name")), as_set(F.col("tags"))], version="v", latest="id")
    assert out.columns == ["s", "k", "v", "change"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_kinds(spark):
    rows = [
        (1, 1, "a", "x", "N", '["p","q"]'), (2, 1, "a", "y", None, None), (3, 1, "a", "z", "Z", "[]"),
        (4, 2, "a", " X ", " N ", '["q", "p", "q"]'), (5, 2, "a", "z", "Z2", None), (6, 2, "a", "w", "W", None), (7, 2, None, "n", "N", None),
    ]
    assert changes(spark, rows) == [("a", "w", 2, "added"), ("a", "y", 2, "removed"), ("a", "z", 2, "changed"), (None, "n", 2, "added")]


def test_highest_id_counts_and_null_equals_empty(spark):
    rows = [(1, 1, "a", "x", "old", None), (2, 1, "a", "x", None, "[]"), (3, 2, "a", "x", "  ", None), (4, 2, "a", "x", "", "")]
    assert changes(spark, rows) == []


def test_gap_is_an_empty_delivery(spark):
    rows = [(1, 1, "a", "x", "N", None), (2, 3, "a", "x", "N", None), (3, None, "a", "x", "N", None)]
    assert changes(spark, rows) == [("a", "x", 2, "removed"), ("a", "x", 3, "added")]


def test_empty_and_single(spark):
    assert changes(spark, []) == []
    assert changes(spark, [(1, 4, "a", "x", "N" * 100_000, "no json")]) == []


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(1, 4), rng.choice("ab"), rng.choice("pqrst"), rng.choice(["N", "M", None, ""]), rng.choice(['["a"]', '["b","a"]', None])) for i in range(120)]
    best = {}
    for i, v, s, k, n, t in rows:
        best[v, s, k] = max(best.get((v, s, k), (-1,)), (i, n or "", tuple(sorted(set(__import__("json").loads(t or "[]"))))))
    want = []
    for v in (2, 3, 4):
        for s in "ab":
            for k in "pqrst":
                a, b = best.get((v - 1, s, k)), best.get((v, s, k))
                if bool(a) != bool(b):
                    want.append((s, k, v, "added" if b else "removed"))
                elif a and a[1:] != b[1:]:
                    want.append((s, k, v, "changed"))
    assert changes(spark, rows) == sorted(want, key=repr)
