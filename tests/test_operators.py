"""Operators on small tables, with brute force where there is an algorithm."""

import random

from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.functions.similarity import gestalt_ratio, indel_ratio, lcs_length
from corvane.operators import lookup, rank, resolve, rules, store
from corvane.operators.graph import components


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diag = 0
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], diag + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs_native_and_bits(spark):
    rng = random.Random(1)
    pairs = [("".join(rng.choices("abc ", k=rng.randint(0, 9))), "".join(rng.choices("abc ", k=rng.randint(0, 9)))) for _ in range(60)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n"), indel_ratio("a", "b").alias("r")).collect():
        assert r.n == lcs(r.a, r.b)
        total = len(r.a) + len(r.b)
        assert abs(r.r - (200 * lcs(r.a, r.b) / total if total else 0)) < 1e-9


def test_gestalt_handles_null(spark):
    df = spark.createDataFrame([("abc", "abd"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(gestalt_ratio("a", "b")).collect()] == [2 / 3, None]


def test_components_against_union_find(spark):
    rng = random.Random(2)
    edges = [(f"n{rng.randint(0, 60):02}", f"n{rng.randint(0, 60):02}") for _ in range(50)] + [("n01", "n01"), (None, "n02")] + [(f"c{i:02}", f"c{i + 1:02}") for i in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a and b and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in parent}
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()}
    assert got == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_latest_and_best(spark):
    df = spark.createDataFrame([(1, "a", "x"), (3, "a", None), (2, "a", "z"), (4, None, "q")], "id long, k string, v string")
    assert [tuple(r) for r in lookup.latest(df, {"k": F.col("k")}, F.col("id"), ["v"]).collect()] == [("a", None)]
    assert [tuple(r) for r in lookup.best(df, {"k": F.col("k")}, [F.col("id")], ["v"]).collect()] == [("a", "x")]


def test_resolve_is_idempotent_and_order_free(spark):
    rows = [("a", "zoncatall", "m.example", ["s1"], 0), ("b", "zoncatall", None, ["s2"], 1), ("c", "zoncatalls", None, ["s3"], 2), ("d", "other thing", "m.example", ["s1"], 3), ("e", "fund one", None, ["s9"], 4), ("f", "fund one", None, ["s9"], 5), ("g", None, None, None, 6)]
    schema = "id string, name string, dom string, src array<string>, canonical int"

    def run(r):
        df = spark.createDataFrame(r, schema)
        out = resolve.resolve(df, row="id", name="name", domain="dom", sources="src", order=[F.lit(0)])
        return {x.id: (x["canonical"], x.is_duplicate, x.match_type) for x in out.collect()}

    first = run(rows)
    assert first == run(rows[::-1])
    assert {first[x][0] for x in "abcd"} == {"a"} and first["d"] == ("a", 1, "domain")
    assert first["e"] == ("e", 0, None) and first["f"] == ("f", 0, None) and first["g"] == ("g", 0, None)


def test_resolution_summary(spark):
    df = spark.createDataFrame([("a", "m.x"), ("b", "m.x"), ("c", "m.x"), ("d", None)], "id string, dom string")
    df = df.withColumn("n", F.col("id")).withColumn("s", F.array(F.col("id")))
    out = resolve.resolve(df, row="id", name="n", domain="dom", sources="s", order=[F.lit(0)])
    r = resolve.resolution_summary(out, df, "dom", "id").first()
    assert (r.before_count, r.after_count, r.duplicates, r.merges, r.domain_unions) == (4, 2, 2, 1, 2)


def test_prefix_dedupe():
    assert resolve.ordered_prefix_dedupe(["lumore energy", "lumore", "geo", "geo fuels", "lumore energy"]) == [True, False, True, True, False]


def test_rank_patterns(spark):
    df = spark.createDataFrame([(i, "g", i >= 3) for i in range(1, 16)], "id int, g string, bad boolean")
    kept = rank.cut_at_rate(df, "g", F.col("id"), F.col("bad"), 0.5, 10).agg(F.max("id")).first()[0]
    assert kept == 10
    marks = rank.within_budget(df, [F.col("id")], 4)
    assert marks.where("allowed").count() == 4 and marks.count() == 15
    assert rank.within_budget(df, [F.col("id")], 0).where("allowed").count() == 15
    assert rank.within_budget(df.where("id > 99"), [F.col("id")], 5).count() == 0
    states = spark.createDataFrame([(5, "10-20"), (41, "10-20"), (40, "10-20"), (7, "unknown"), (7, None)], "n int, e string")
    assert [r[0] for r in states.select(rank.yield_state(F.col("n"), F.col("e"))).collect()] == ["low", "high", "ok", "ok", "ok"]


def test_store(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), (None, 5), (None, 5)], "k string, v int")
    assert sorted((tuple(r) for r in store.insert_or_ignore(old, new, ["k"]).collect()), key=repr) == [("a", 1), ("b", 2), (None, 5), (None, 5)]
    assert sorted(tuple(r) for r in store.insert_or_replace(old, new.where("k = 'a'"), ["k"]).collect()) == [("a", 9)]
    assert [tuple(r) for r in store.update_columns(old, new.where("k = 'a'"), "k", ["v"], F.col("v") > 5).collect()] == [("a", 1)]
    assert [tuple(r) for r in store.fill_columns(old, new.where("k = 'a'"), "k", ["v"]).collect()] == [("a", 1)]


def test_rules(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    found = rules.first_match([rules.Rule("A", F.col("x") > 3, F.lit("big")), rules.Rule("B", F.col("x") > 0, F.lit("some"))])
    assert [r[0] for r in df.select(found.rule_id).collect()] == ["B", "A", None]
    s = rules.fired([rules.Signal("h", F.col("x") > 3, 3, "HIGH", F.lit("e")), rules.Signal("l", F.col("x") > 0, 1, "LOW", F.lit("e"), F.col("x") == 1, "weak")])
    out = df.select(rules.total(s), rules.only(s, "LOW"), rules.flagged(s), rules.trace(s)).collect()
    assert [tuple(r) for r in out] == [(0.0, False, True, "l=0.0"), (4.0, False, False, "h=3.0; l=1.0"), (0.0, False, False, "")]


def test_text_functions(spark):
    df = spark.createDataFrame([("Zoncatal LLC (x)", "https://www.Foo.com/a?b", "Ordovanta – Lumen (Coming Soon)", "Calgary, Canada-based Quillmere Glazes, which makes glaze")], "a string, b string, c string, d string")
    name, programme, soon = tx.split_program("c")
    item, about, place = tx.list_item("d")
    r = df.select(tx.match_name("a"), tx.bare_domain("b"), name, programme, soon, item, about, place).first()
    assert tuple(r) == ("zoncatal", "foo.com", "Ordovanta", "Lumen", True, "Quillmere Glazes", "makes glaze", "Calgary, Canada")


def test_crowded_blocks_give_the_same_pairs(spark):
    """One prefix in all names, half of them slips of others: by segments as by comparing all."""
    import random

    from corvane.functions.similarity import _indel, indel_ratio
    from corvane.operators.resolve import blocked_pairs
    from corvane.scratch import Scratch

    rng = random.Random(8)
    names = []
    for _ in range(120):
        n = "acme" + "".join(rng.choices("abcdefgh ", k=rng.randrange(1, 30)))
        for _ in range(rng.randrange(1, 3)):
            i = rng.randrange(4, len(n) + 1)
            n = rng.choice([n[:i] + rng.choice("abcxyz") + n[i:], n[:i] + n[i + 1 :], n])
            names.append(n)
    groups = spark.createDataFrame([(f"{i:04}", n) for i, n in enumerate(names)], "g string, t string")
    pairs = blocked_pairs(groups, "t", "t", 88.0, 10, Scratch(spark))
    both = pairs.join(groups, "g").join(groups.toDF("h", "u"), "h").where(indel_ratio("t", "u") >= 88)
    want = {(f"{i:04}", f"{j:04}") for i in range(len(names)) for j in range(i + 1, len(names)) if _indel(names[i], names[j]) >= 88}
    assert len(want) > 60 and {(r.g, r.h) for r in both.collect()} == want
