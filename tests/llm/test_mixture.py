"""Mixing: budgets, caps, epochs, absent sources."""

from corvane.llm.mixture import mix_sources


def run(spark, docs, targets, **k):
    d = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    mix, report = mix_sources(d, t, **k)
    return [tuple(r) for r in mix.collect()], {r.source: r.asDict() for r in report.collect()}


def test_budgets_and_caps(spark):
    docs = [(i, "big", 10) for i in range(1000)] + [(2000 + i, "small", 7) for i in range(30)] + [(5000, None, 9), (5001, "other", 9), (5002, "big", 0), (5003, "big", None)]
    mix, rep = run(spark, docs, [("big", 0.5, 1), ("small", 0.3, 4), ("gone", 0.2, 2)], total_tokens=4000, ranges=8)
    assert rep["big"]["taken_tokens"] == 2000 and rep["small"]["taken_tokens"] == 840 and rep["small"]["epochs"] == 4
    assert rep["gone"]["taken_tokens"] == 0 and rep["gone"]["actual_share"] == 0.0
    assert abs(sum(r["actual_share"] for r in rep.values()) - 1) < 1e-9
    assert len(mix) == len(set(mix)) and all(m[2] == 1 for m in mix if m[0] == "big")
    assert {m[2] for m in mix if m[0] == "small"} == {1, 2, 3, 4}


def test_cut_is_exact_to_a_document(spark):
    docs = [(i, "s", 1 + i % 5) for i in range(500)]
    _, rep = run(spark, docs, [("s", 1.0, 3)], total_tokens=2222, ranges=16)
    assert 2222 - 5 < rep["s"]["taken_tokens"] <= 2222 and rep["s"]["epochs"] == 2


def test_same_whatever_the_ranges(spark):
    docs = [(i, "s", 3) for i in range(200)]
    a, _ = run(spark, docs, [("s", 1.0, 1)], total_tokens=99, ranges=1)
    assert len(a) == 33


def test_empty(spark):
    mix, rep = run(spark, [], [("s", 1.0, 1)])
    assert mix == [] and rep["s"]["taken_tokens"] == 0
