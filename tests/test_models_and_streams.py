"""Model calls, prompts, streams and the pipeline."""

import pytest
from pyspark.sql import functions as F

from corvane import pipeline
from corvane.model_calls.map import add_known, answered, call_model, costs
from corvane.model_calls.prompts import prompt_path, prompt_versions, render
from corvane.model_calls.provider import Answer, KeywordProvider, Retryable, parse_answer, with_retries
from corvane.streaming.ingest import first_within, sessions, stream_tables, upsert_into


def test_prompts(tmp_path):
    (tmp_path / "c_v1.md").write_text("---\na: b\n---\nSys {{x}}\n---USER---\nAsk {{ x }}")
    assert prompt_versions(tmp_path, "c") == ["v1"]
    with pytest.raises(FileNotFoundError):
        prompt_path(tmp_path, "c", "v2")
    system, user = render(prompt_path(tmp_path, "c", "v1").read_text(), {"x": 1}, [{"input": {"q": 1}, "output": {"a": 2}}], {"label": "string"})
    assert system.startswith("Sys 1") and "Example 1" in system and user.startswith("Ask 1") and "JSON" in user
    with pytest.raises(KeyError):
        render("{{y}}", {})


def test_retries():
    waits, left = [], [2]

    def call():
        if left[0]:
            left[0] -= 1
            raise Retryable
        return Answer("x", 0, 0)

    assert with_retries(call, sleep=waits.append).text == "x" and waits == [4.0, 8.0]
    with pytest.raises(Retryable):
        with_retries(lambda: (_ for _ in ()).throw(Retryable()), attempts=2, sleep=waits.append)
    assert parse_answer("```json\n{\"a\": 1}\n```") == {"a": 1} and parse_answer("[]") is None


def test_call_model(spark):
    class Flaky:
        """Answers nothing readable."""

        def ask(self, system, user, max_tokens):
            return Answer("no json", 1, 1)

    df = spark.createDataFrame([(1, "grid grid"), (2, None), (3, "nothing here"), (4, "grid")], "id int, t string")
    log = call_model(df, "id", ["t"], "---USER---\n{{t}}", KeywordProvider({"grid": ["grid"]}), budget=3, least_text=3).cache()
    assert {r.id: r.status for r in log.collect()} == {1: "ok", 2: "short", 3: "ok", 4: "over_budget"}
    out = {r.id: r.label for r in answered(df, log, "id", "label string", {"label": "none"}).collect()}
    assert out == {1: "grid", 2: None, 3: "unknown", 4: None}
    bad = call_model(df, "id", ["t"], "{{t}}", Flaky())
    assert {r.label for r in answered(df, bad, "id", "label string", {"label": "none"}).collect()} == {"none"}
    assert costs(log, 3.0, 15.0).count() == 3
    assert {r.status for r in call_model(df, "id", ["t"], "{{t}}", Flaky(), dry_run=True).collect()} == {"dry_run"}


def test_add_known(spark):
    df = spark.sql("select array(named_struct('name', 'Ann')) f, array(named_struct('name', 'ann'), named_struct('name', 'Bob'), named_struct('name', 'Cy')) k")
    assert [x.name for x in df.select(add_known(F.col("f"), F.col("k"), "name").alias("x")).first().x] == ["Cy", "Bob", "Ann"]


def test_upsert_stream(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in ([("a", 1), ("b", 2)], [("a", 9), ("c", 3)]):
        spark.createDataFrame(part, "k string, v int").coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    upsert_into(stream_tables(spark, src, schema), out, ["k"], str(tmp_path / "cp"))
    last = spark.read.parquet(f"{out}/batch=1")
    assert {r.k for r in last.collect()} == {"a", "b", "c"} and last.count() == 3


def test_stateful_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("select * from values ('a', timestamp'2026-01-01 00:00:00'), ('a', timestamp'2026-01-01 00:01:00'), ('a', timestamp'2026-01-01 01:00:00') t(k, ts)").coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    for name, df, mode, n in (("d1", first_within(stream_tables(spark, src, schema), "ts", ["k"], "2 hours"), "append", 1), ("d2", sessions(stream_tables(spark, src, schema), "ts", "1 hour", "10 minutes", "k"), "complete", 2)):
        df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
        assert spark.table(name).count() == n


def test_pipeline(spark, data, tmp_path):
    raw = spark.read.parquet(f"{data}/raw_records.parquet").withColumnRenamed("id", "raw_id")
    companies = pipeline.consolidate(raw)
    assert companies.count() == companies.select("id").distinct().count() > 0
    assert pipeline.consolidate(raw, companies).count() == 0
    resolved = pipeline.resolve_stage(companies)
    pipeline.export(resolved, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == companies.count()
    merged, audit = pipeline.harvest({"a": raw.select("name_raw").limit(3), "zz": raw.select("name_raw")}, {"a"})
    assert merged.count() == 3 and audit.count() == 1
