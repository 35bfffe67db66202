"""Survivorship and truth discovery."""

from pyspark.sql import functions as F

from corvane.llm.survivor import duplicate_groups, instant, present_text, survivors, trust_of, truth_discovery, valid_score


def test_parsers(spark):
    df = spark.createDataFrame([("1672912366", "N/A ", 3.0), ("2023-01-05 02:37:04", " x", float("nan")), ("2023-01-05T02:37:04+02:00", "", 11.0), ("unknown", None, None), (None, "-", 0.0)], "t string, s string, n double")
    out = df.select(instant("t").alias("i"), present_text("s").alias("p"), valid_score("n").alias("v")).collect()
    assert [r.i for r in out] == [1672912366 * 10**6, 1672886224 * 10**6, 1672879024 * 10**6, None, None]
    assert [r.p for r in out] == [False, True, False, False, False] and [r.v for r in out] == [True, False, False, False, True]


def _found(spark, rows, bound=10_000):
    df = spark.createDataFrame(rows, "id string, canonical_id string, source_ids string, score double, note string")
    reg = spark.createDataFrame([("S1 ", 1), ("s2", 2), (None, 0)], "source_name string, trust_rank int")
    members = trust_of(duplicate_groups(df, "id", "canonical_id"), reg, "id", "source_ids", bound)
    fields = {"record": (F.lit(True), []), "note": (present_text("note"), []), "low": (F.col("score").isNotNull(), [F.col("score")])}
    out = survivors(members, "id", [F.col("trust"), -F.coalesce("score", F.lit(0.0))], fields)
    return sorted(tuple(r) for r in out.collect())


ROWS = [("a", " B", '["s2"]', 5.0, None), ("b", None, '["x", "S1"]', 1.0, "tbd"), ("c", "b", "no json", 9.0, "n"), ("d", "gone", '["s1"]', 1.0, "n"), ("e", "e", '["s1"]', 1.0, "n"), ("f", "", None, None, None)]


def test_precedence(spark):
    want = [("b", "low", "b"), ("b", "note", "c"), ("b", "record", "b")]
    assert _found(spark, ROWS) == want
    assert _found(spark, ROWS, bound=0) == want
    assert _found(spark, ROWS + ROWS) == want


def test_row_in_two_groups_and_empty(spark):
    rows = [("a", "b", None, None, None), ("b", None, None, None, None), ("c", "a", None, None, None)]
    assert _found(spark, rows) == [("a", "record", "a"), ("b", "record", "a")]
    assert _found(spark, []) == []


def test_truth_discovery_finds_the_unreliable_source(spark):
    claims = []
    for g in range(40):
        claims += [(f"g{g}", "f", f"v{g}", s) for s in ("good1", "good2")] + [(f"g{g}", "f", f"w{g}", "bad")]
    claims += [("tie", "f", "only", "bad"), ("tie", "f", "true", "good1"), ("n", "f", None, "good1"), ("n", "f", "x", None)]
    chosen, trust = truth_discovery(spark.createDataFrame(claims, "group_id string, field_name string, value string, source string"))
    got = {r.group_id: r.value for r in chosen.collect()}
    assert all(got[f"g{g}"] == f"v{g}" for g in range(40)) and got["tie"] == "true" and got["n"] == "x"
    r = {x.source: x.reliability for x in trust.collect()}
    assert r["bad"] < r["good1"]


def _by_the_book(claims, prior=0.8, tolerance=1e-3):
    """Truth discovery claim by claim."""
    import math

    said = {(g, f, v, s or "") for g, f, v, s in claims if v is not None}
    trust = {s: prior for *_, s in said}
    while True:
        votes, total = {}, {}
        for g, f, v, s in sorted(said):
            w = max(0.05, math.log(trust[s] / (1 - trust[s])))
            votes[g, f, v] = votes.get((g, f, v), 0) + w
            total[g, f] = total.get((g, f), 0) + w
        share = {k: x / total[k[:2]] for k, x in votes.items()}
        new = {}
        for s in trust:
            own = [share[g, f, v] for g, f, v, t in said if t == s]
            new[s] = max(0.05, min(0.95, (sum(own) + 4 * prior) / (len(own) + 4)))
        moved = max(abs(new[s] - trust[s]) for s in trust)
        trust = new
        if moved < tolerance:
            break
    votes, total = {}, {}
    for g, f, v, s in said:
        w = max(0.05, math.log(trust[s] / (1 - trust[s])))
        votes[g, f, v] = votes.get((g, f, v), 0) + w
        total[g, f] = total.get((g, f), 0) + w
    best = {}
    for (g, f, v), x in votes.items():
        best[g, f] = min(best.get((g, f), (1, "")), (-round(x / total[g, f], 9), v))
    return {k: (v, -x) for k, (x, v) in best.items()}, trust


def test_truth_discovery_equals_brute_force_and_finds_planted_truths(spark):
    """Six sources of known reliability, three wrong values a field: as claim by claim, and right where the good ones say it."""
    import random

    rng = random.Random(3)
    right = {"a": 0.95, "b": 0.9, "c": 0.7, "d": 0.5, "e": 0.3, "f": 0.2}
    claims = []
    for g in range(300):
        for field in ("x", "y"):
            for s in rng.sample(sorted(right), rng.randrange(2, 6)):
                claims.append((f"g{g}", field, "true" if rng.random() < right[s] else f"wrong{rng.randrange(3)}", s))
    claims += [("n", "x", None, "a"), ("n", "x", "v", None), ("n", "x", "v", None), ("two", "x", "p", "a"), ("two", "x", "q", "a")]
    chosen, trust = truth_discovery(spark.createDataFrame(claims, "group_id string, field_name string, value string, source string"))
    want, reliable = _by_the_book(claims)
    got = {(r.group_id, r.field_name): (r.value, round(r.support, 6)) for r in chosen.collect()}
    assert got == {k: (v, round(x, 6)) for k, (v, x) in want.items()}
    found = {r.source: r.reliability for r in trust.collect()}
    assert all(abs(found[s] - reliable[s]) < 1e-9 for s in reliable)
    order = sorted(right, key=lambda s: -found[s])
    assert order[:2] in (["a", "b"], ["b", "a"]) and set(order[-2:]) == {"e", "f"}
    assert sum(v == "true" for k, (v, _) in got.items() if k[0].startswith("g")) / 600 >= 0.85


def test_truth_discovery_of_nothing(spark):
    chosen, trust = truth_discovery(spark.createDataFrame([], "group_id string, field_name string, value string, source string"))
    assert chosen.count() == 0 and trust.count() == 0
