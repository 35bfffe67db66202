"""What functions and passes must give, by example: not from the constants they use."""

import pytest
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.model_calls import answers
from corvane.model_calls.library import prompt_text, versions
from corvane.operators.passes import Pass, run_missing, running_summary


def _each(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_identifiers_from_names(spark):
    names = {
        "Acme Factory Inc.": "acme-factory", "Acme Capital": "acme", "North District": "north-district", "Acme Ventures, LLC": "acme-ventures", "Zoë Laboratory": "zoe", "Acme GmbH": "acme-gmbh",
        "Partners": "", "Biotech": "biotech", "Acme Tech . ": "acme-tech", "Acme tech. ": "acme", None: None, "": "",
    }
    assert _each(spark, list(names), tx.name_slug("x")) == list(names.values())
    assert _each(spark, ["www.Acme.com", "https://a.b.edu/x", "nothing"], tx.domain_slug("x")) == ["acme-com", "a-b-edu", None]
    assert _each(spark, ["  Acme \t Factory  Services ", "Acme, Limited"], tx.display_key("x")) == ["acme factory", "acme, limited"]


def test_json_or_raw_text(spark):
    got = _each(spark, ['["a", "b"]', "plain text", "", None, "{broken", '{"k": 1}'], tx.json_or_text("x", "array<string>"))
    assert [(r.value, r.text) for r in got] == [(["a", "b"], None), (None, "plain text"), (None, None), (None, None), (None, "{broken"), (None, None)]


def test_unknown_models_cost_the_default(spark):
    cost = tx.model_cost("x", F.lit(1_000_000), F.lit(1_000_000), {"a": (1.0, 2.0), "b": (10.0, 20.0)}, "a")
    assert _each(spark, ["a", "b", "other", None], cost) == [3.0, 30.0, 3.0, 3.0]


@pytest.mark.parametrize(
    "row,want",
    [(("off_thesis", 5.0, "LOW", ""), "off_thesis"), (("x", 5.0, "low", " "), "pending_description"), (("x", 5.0, "LOW", "text"), "enriched"), (("x", 5.0, "HIGH", None), "enriched"), ((None, None, None, None), "enriched"), ((None, 5.0, "Low", None), "pending_description")],
)
def test_status(spark, row, want):
    df = spark.createDataFrame([row], "a string, s double, c string, t string")
    assert df.select(tx.enrichment_status("a", "s", "c", "t").alias("v")).first().v == want


def test_image_names(spark):
    urls = ["https://cdn.x/0123456789abcdef01234567_acme-grid-logo.png", "https://cdn.x/a/Acme_Power.SVG?v=1", "https://cdn.x/acme.v2.jpg", "https://cdn.x/logo.png", "https://cdn.x/0123_acme.webp", None]
    assert _each(spark, urls, tx.name_from_image("x")) == ["Acme Grid", "Acme Power", "Acme.", None, "0123 Acme", None]


def test_only_what_is_missing_runs(spark):
    df = spark.createDataFrame([(1, "", None), (2, "a", 3.0), (3, None, 4.0)], "id int, s string, n double")
    once = run_missing(df, [Pass("s", F.lit("new")), Pass("n", F.lit(None).cast("double"))])
    assert sorted((r.id, r.s, r.n, r.ran) for r in once.collect()) == [(1, "new", None, ["s", "n"]), (2, "a", 3.0, []), (3, "new", 4.0, ["s"])]
    forced = run_missing(df, [Pass("s", F.upper("s"), force=True)])
    assert {r.id: r.s for r in forced.collect()} == {1: "", 2: "A", 3: None}


def test_running_summary(spark):
    rows = [("a", i, i in (2, 3)) for i in range(1, 6)] + [("b", 1, False)]
    out = running_summary(spark.createDataFrame(rows, "g string, i int, bad boolean"), "g", F.col("i"), F.col("bad"), 2)
    got = {r.g: (r.n_runs, r.n_failed, round(r.worst_rate, 3), r.sample) for r in out.collect()}
    assert got == {"a": (5, 2, 0.667, [1, 2]), "b": (1, 0, 0.0, [1])}


def test_classes_come_from_the_map(spark):
    df = spark.createDataFrame([(1, "wind", "LOW"), (2, "magic", "HIGH"), (3, None, "HIGH")], "id int, label string, confidence string")
    got = {r.id: (r.label, r.confidence, r.parent) for r in answers.corrected(df, "label", "confidence", {"wind": "energy"}, ("off", "none", "LOW")).collect()}
    assert got == {1: ("wind", "LOW", "energy"), 2: ("off", "LOW", "none"), 3: ("off", "LOW", "none")}


def test_prompts_of_the_package():
    assert versions("classify") == ["v1", "v2"] and prompt_text("classify", "v1").startswith("Version v1")
    with pytest.raises(FileNotFoundError):
        prompt_text("classify", "v9")


def test_stages_of_the_command_line(spark, data, tmp_path):
    from corvane.pipeline import main

    main(["score", "--data", data, "--out", str(tmp_path / "a")])
    scored = spark.read.parquet(f"{tmp_path}/a/companies")
    assert {"label", "confidence", "score", "band", "description"} <= set(scored.columns) and scored.count() == scored.select("id").distinct().count() > 0
    assert {r.band for r in scored.select("band").distinct().collect()} <= {"full", "part", "bare"}
    main(["run", "--data", data, "--out", str(tmp_path / "b")])
    out = spark.read.option("header", True).csv(f"{tmp_path}/b/csv")
    assert out.count() == scored.count() and {"canonical", "is_duplicate", "match_type"} <= set(out.columns)
