"""Survey queries of the passes over a store (X, K), paged and archived reads (S), and model answers (L), over whole tables."""

from __future__ import annotations

import io
import json
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.model_calls import answers
from corvane.model_calls.map import call_model, costs
from corvane.model_calls.provider import KeywordProvider
from corvane.operators import lookup, passes, store
from corvane.plans.common import table
from corvane.plans.functions_sql import _slug_sql, _title
from corvane.plans.scans_sql import _N, _X, _pages, _safe
from corvane.scratch import Scratch, scratch_dir
from corvane.sources import feeds, layouts
from corvane.sources.html import scan_pages
from corvane.sources.paged import PagedSearch, first_platform, with_fallback
from corvane.streaming.ingest import first_within

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _place(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/store-{uuid.uuid4().hex}"


def _score() -> Column:
    return F.when(F.col("venture_scale_score").between(0, 10) & ~F.isnan("venture_scale_score"), F.col("venture_scale_score"))


_SCORE_SQL = "CASE WHEN venture_scale_score BETWEEN 0 AND 10 AND NOT isnan(venture_scale_score) THEN venture_scale_score END"


@query("SELECT id, name, slug, page FROM (SELECT id, name, 'p' || CASE WHEN sub_sector IS NULL THEN 'x' ELSE sub_sector END AS page, id AS slug FROM companies) WHERE name IS NOT NULL")
def sv_s01_two_passes(spark: SparkSession, folder: str) -> DataFrame:
    """The listings of two years, then the profile of each entry: an entry whose profile cannot be read stays as a listing-only
    record (S01, S01d); an entry of both years is the one of the first, and a year without a listing gives none."""
    c = table(spark, folder, "companies").where("name is not null")
    years = [c.where("is_duplicate = 0 or is_duplicate is null"), c, c.where(F.lit(False))]
    listing = first_platform([y.select("id", "name", F.col("id").alias("slug")) for y in years], "id").drop("platform_rank")
    profiles = c.where("sub_sector is not null").select("id", F.concat(F.lit("p"), "sub_sector").alias("page"))
    return with_fallback(lookup.attach(listing, profiles, ["id"]), {"page": F.lit("px")}).select("id", "name", "slug", "page")


_CUT_SQL = rf"regexp_replace({_slug_sql('name')}, '[-_]?(logo|icon|img|image|thumbnail|photo|full|white|dark|color|bw|black|new|v[0-9]+).*$', '')"


@query(rf"SELECT id, coalesce(nullif({_title("trim(translate(" + _CUT_SQL + ", '-_', '  '))")}, ''), nullif({_title("trim(translate(id, '-_', '  '))")}, '')) AS name FROM companies")
def sv_s05_inferred_names(spark: SparkSession, folder: str) -> DataFrame:
    """Logo cards with the name in the image, else in the domain (S05 with F14 and F15)."""
    image = F.concat(F.lit("https://cdn.example/0123456789abcdef01234567_"), tx.slug("name"), F.lit(".png"))
    html = F.concat(F.lit("<div class='companies__item w-dyn-item'><a class='companies__card' href='https://www."), "id", F.lit(".example'><img class='companies__logo' src='"), image, F.lit("'></a></div>"))
    cards = scan_pages(table(spark, folder, "companies").select("id", html.alias("html")), layouts.LOGO_CARDS, "id")
    return cards.select("id", F.coalesce(tx.name_from_image("image"), tx.name_from_domain("website")).alias("name"))


@query(f"SELECT id, name, coalesce(nullif({_X}, ''), 'short') AS about FROM (SELECT id, {_N} AS name, sub_sector FROM companies) WHERE name <> ''")
def sv_s06_paged_members(spark: SparkSession, folder: str) -> DataFrame:
    """Members of a listing read page by page until one says it has none, with the text of the detail page where there is
    one, else the short one (S06)."""
    c = table(spark, folder, "companies").select("id", _safe("name").alias("n"), _safe("sub_sector").alias("x"))
    cards = F.concat(F.lit("<a class='col-4 card' href='https://x.example/members/"), "id", F.lit("/'><h2 class='entry-title'>"), "n", F.lit("</h2></a>"))
    pages = c.select("id", F.explode(F.array(F.struct(F.lit(1).alias("page"), cards.alias("html")), F.struct(F.lit(2).alias("page"), F.lit("<p class='no-results'>none</p>").alias("html")))).alias("p")).select("id", "p.*")
    members = scan_pages(pages.select("id", "html"), layouts.MEMBERS, "id").select("id", "name")
    return with_fallback(lookup.attach(members, c.select("id", tx.blank_to_null("x").alias("about")), ["id"]), {"about": F.lit("short")})


@query("SELECT 'F-' || o_orderkey AS adsh, o_custkey AS owner FROM orders")
def sv_s13_paged_filings(spark: SparkSession, folder: str) -> DataFrame:
    """Hits of a service that gives pages of 100 until one is short: a Python data source with a partition a query."""
    spark.dataSource.register(PagedSearch)
    place = _place(spark)
    hits = table(spark, folder, "orders").select(F.pmod("o_custkey", F.lit(8)).alias("part"), F.to_json(F.struct(F.concat(F.lit("F-"), "o_orderkey").alias("adsh"), F.col("o_custkey").alias("owner"))).alias("value"))
    hits.repartition(8, "part").write.partitionBy("part").text(place)
    found = spark.read.format("paged_search").option("folder", place).option("size", "100").load()
    return found.select(F.get_json_object("item", "$.adsh").alias("adsh"), F.get_json_object("item", "$.owner").cast("long").alias("owner"))


def _workbook(sheets: dict[str, list[tuple]]) -> bytes:
    """A workbook of texts, as the format has it: one part a sheet, cells with their texts inside."""
    out = io.BytesIO()
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        for i, rows in enumerate(sheets.values(), 1):
            cells = "".join("<row>" + "".join(f'<c r="{chr(65 + j)}{k}" t="inlineStr"><is><t>{v}</t></is></c>' for j, v in enumerate(row) if v is not None) + "</row>" for k, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{cells}</sheetData></worksheet>')
    return out.getvalue()


@query("SELECT '24INR' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS number, 'E' || c_custkey AS entity, c_custkey % 2 AS large FROM customer WHERE c_custkey % 3 <> 0")
def sv_s14_worksheets(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of two sheets of workbooks, archived as files and read again (S14, K15): those below the header, of a zone."""
    spark_rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"))

    def books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for at in range(0, len(batch), 500):
                keys = [int(k) for k in batch["k"].iloc[at : at + 500]]
                row = lambda k: (f"24INR{k % 10000:04}", "HOUSTON" if k % 3 else "WEST", f"E{k}", "SGIA signed")
                sheets = {name: [("INR", "Zone", "Entity", "Phase"), *[row(k) for k in keys if k % 2 == large]] for name, large in (("Large Gen", 1), ("Small Gen", 0))}
                found.append((f"b{keys[0]}", _workbook(sheets)))
            yield pd.DataFrame(found, columns=["path", "content"])

    archive = Scratch(spark).keep(spark_rows.mapInPandas(books, "path string, content binary"))
    rows = feeds.scan_worksheets(archive, ["Large Gen", "Small Gen"], ["number", "zone", "entity", "phase"])
    return feeds.queue_rows(rows, "HOUSTON", "Large Gen").select("number", "entity", (F.col("sheet") == "Large Gen").cast("long").alias("large"))


@query("SELECT lower(trim(r.source)) AS source, s.trust_rank, count(*) AS n FROM raw_records r JOIN source_registry s ON lower(trim(s.source_name)) = lower(trim(r.source)) WHERE s.active GROUP BY 1, 2")
def sv_s19_json_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension loaded from JSON once and joined (S19, S22): its size is the planner's to judge."""
    place = _place(spark)
    table(spark, folder, "source_registry").select(F.lower(F.trim("source_name")).alias("source"), "trust_rank", "active").write.json(place)
    known = spark.read.schema("source string, trust_rank int, active boolean").json(place).where("active")
    raw = table(spark, folder, "raw_records").select(F.lower(F.trim("source")).alias("source"))
    return raw.join(known, "source").groupBy("source", "trust_rank").agg(F.count("*").alias("n"))


@query("SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_regionkey = 1")
def sv_s21_database(spark: SparkSession, folder: str) -> DataFrame:
    """A table of a database, read by predicates over a key, each a partition; filters and columns go to the database."""
    from corvane.sources.database import read_sqlite, write_sqlite

    place = f"{Scratch(spark).root}/places.db"
    write_sqlite(table(spark, folder, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("long").alias("region")), place, "places", "id")
    return read_sqlite(spark, place, "places", "id long, name string, region long", "id", 4).where("region = 1").select("id", "name")


@query("SELECT load_no, source, count(*) AS n_runs, count(*) FILTER (success = 1) AS n_good, CAST(sum(CASE WHEN success = 1 THEN coalesce(records_harvested, 0) ELSE 0 END) AS BIGINT) AS records FROM harvest_runs GROUP BY 1, 2")
def sv_k01_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Audit of the runs of each source and load, appended load by load and read again."""
    place = _place(spark)
    runs = table(spark, folder, "harvest_runs").select("load_no", "source", "success", "records_harvested")
    for part in ("load_no <= 6", "load_no > 6 or load_no is null"):
        good = F.col("success") == 1
        audit = runs.where(part).groupBy("load_no", "source").agg(F.count("*").alias("n_runs"), F.count_if(good).alias("n_good"), F.sum(F.when(good, F.coalesce("records_harvested", F.lit(0))).otherwise(0)).alias("records"))
        store.save(audit, place)
    return spark.read.parquet(place).select("load_no", "source", "n_runs", "n_good", "records")


@query(f"SELECT id, CASE WHEN coalesce(sub_sector, '') = '' THEN 'unknown' ELSE sub_sector END AS sub_sector, CASE WHEN coalesce(summary, '') = '' THEN 'About ' || id ELSE summary END AS summary, coalesce({_SCORE_SQL}, 5.0) AS score, CAST(coalesce(sub_sector, '') = '' AS INTEGER) + CAST(coalesce(summary, '') = '' AS INTEGER) + CAST(({_SCORE_SQL}) IS NULL AS INTEGER) AS ran FROM companies")
def sv_x06_missing_passes(spark: SparkSession, folder: str) -> DataFrame:
    """Three passes over every company, each only where its field is missing, written with what ran; a second run changes
    nothing (X06, K05, P10)."""
    c = table(spark, folder, "companies").select("id", "sub_sector", "summary", _score().alias("score"))
    steps = [passes.Pass("sub_sector", F.lit("unknown")), passes.Pass("summary", F.concat(F.lit("About "), "id")), passes.Pass("score", F.lit(5.0))]
    once = passes.run_missing(c, steps)
    twice = passes.run_missing(once.drop("ran"), steps)
    return once.join(twice.select(F.col("id").alias("__id"), F.size("ran").alias("again")), F.col("id") == F.col("__id")).where("again = 0").select("id", "sub_sector", "summary", "score", F.size("ran").alias("ran"))


@query("SELECT id, CASE WHEN is_duplicate = 1 THEN 'skipped' WHEN sub_sector = 'off_thesis' THEN 'off_thesis' WHEN venture_scale_score = 5.0 AND upper(coalesce(venture_scale_confidence, '')) = 'LOW' AND trim(coalesce(summary, '')) = '' THEN 'pending_description' ELSE 'enriched' END AS status FROM companies")
def sv_k07_status(spark: SparkSession, folder: str) -> DataFrame:
    """Bulk update of the status of all rows that are no duplicates (K07 with F37)."""
    c = table(spark, folder, "companies").withColumn("status", F.lit("skipped"))
    new = c.select("id", tx.enrichment_status("sub_sector", "venture_scale_score", "venture_scale_confidence", "summary").alias("status"))
    return store.update_columns(c.select("id", "status", "is_duplicate"), new, "id", ["status"], F.coalesce(F.col("is_duplicate") != 1, F.lit(True))).select("id", "status")


@query("SELECT id, CAST(coalesce(canonical_id, '') <> '' AND lower(trim(canonical_id)) <> id AS INTEGER) AS is_duplicate FROM companies")
def sv_k06_reset(spark: SparkSession, folder: str) -> DataFrame:
    """Flags of the last run dropped and set again from the pointers."""
    c = table(spark, folder, "companies").select("id", "canonical_id", F.lit(0).alias("is_duplicate"))
    found = c.where((F.coalesce("canonical_id", F.lit("")) != "") & (F.lower(F.trim("canonical_id")) != F.col("id"))).select("id", F.lit(1).alias("is_duplicate"))
    return store.update_columns(c, found, "id", ["is_duplicate"]).select("id", "is_duplicate")


_HITS = "(length({t}) - length(replace({t}, '{w}', ''))) // length('{w}')"
_HYDRO = _HITS.format(t="t", w="hydrogen")
_HEAT = f"({_HITS.format(t='t', w='geothermal')} + {_HITS.format(t='t', w='thermal')})"
_ANSWER_SQL = f"SELECT id, t, {_HYDRO} AS h, {_HEAT} AS g FROM (SELECT id, lower(coalesce(trim(summary), '')) AS t FROM companies)"
_CALLED = "length(t) >= 20"
_MODEL = KeywordProvider({"hydrogen": ["hydrogen"], "geothermal": ["geothermal", "thermal"]})


def _calls(spark: SparkSession, folder: str, **options) -> DataFrame:
    return call_model(table(spark, folder, "companies"), "id", ["summary"], "Classify.\n---USER---\n{{summary}}", _MODEL, least_text=20, **options)


@query(f"SELECT id, CASE WHEN {_CALLED} THEN CASE WHEN h = 0 AND g = 0 THEN 'unknown' WHEN h >= g THEN 'hydrogen' ELSE 'geothermal' END END AS label, CASE WHEN {_CALLED} THEN CASE WHEN greatest(h, g) > 1 THEN 'HIGH' ELSE 'LOW' END END AS confidence, CASE WHEN {_CALLED} THEN greatest(h, g) END AS hits FROM ({_ANSWER_SQL})")
def sv_l05_answers(spark: SparkSession, folder: str) -> DataFrame:
    """The fields of the answers of the offline model for every summary, with defaults where an answer is no good and NULL
    where none was asked for (L01, L05, L08)."""
    log = Scratch(spark).keep(_calls(spark, folder))
    out = answers.fields(table(spark, folder, "companies").select("id"), log, "id", "label string, confidence string, hits bigint", {"label": "unknown", "confidence": "LOW", "hits": 0})
    return out.select("id", "label", "confidence", "hits")


@query(f"SELECT id, CASE WHEN label IN ('hydrogen', 'geothermal') THEN label ELSE 'off_thesis' END AS primary_class, CASE WHEN label IN ('hydrogen', 'geothermal') THEN 'energy' ELSE 'none' END AS parent, CASE WHEN label IN ('hydrogen', 'geothermal') THEN confidence ELSE 'LOW' END AS confidence, CAST(hits = 0 OR (CASE WHEN label IN ('hydrogen', 'geothermal') THEN confidence ELSE 'LOW' END) = 'LOW' AS INTEGER) AS review FROM (SELECT id, CASE WHEN h = 0 AND g = 0 THEN 'unknown' WHEN h >= g THEN 'hydrogen' ELSE 'geothermal' END AS label, CASE WHEN greatest(h, g) > 1 THEN 'HIGH' ELSE 'LOW' END AS confidence, greatest(h, g) AS hits FROM ({_ANSWER_SQL}) WHERE {_CALLED})")
def sv_l07_corrected(spark: SparkSession, folder: str) -> DataFrame:
    """The primary class from the map of classes, whatever the model says of it; a class that is not in the map is off thesis,
    of low confidence; the flag for review follows where the answer has none (L06, L07)."""
    log = Scratch(spark).keep(_calls(spark, folder))
    got = log.where("status = 'ok'").select("id", F.from_json("answer", "label string, confidence string, hits bigint, review boolean").alias("a")).select("id", "a.*")
    fixed = answers.corrected(got, "label", "confidence", {"hydrogen": "energy", "geothermal": "energy"}, ("off_thesis", "none", "LOW"))
    review = answers.needs_review(F.col("review"), F.col("hits") == 0, F.col("confidence"))
    return fixed.select("id", F.col("label").alias("primary_class"), "parent", "confidence", review.cast("int").alias("review"))


@query("SELECT company_id AS id, source, least(sum(w), 3.5) AS points FROM (SELECT company_id, source, CASE WHEN confidence >= 0.8 THEN 2.0 ELSE 1.0 END AS w FROM founder_company_edges WHERE length(trim(coalesce(evidence, ''))) >= 20 AND source IN ('roster_lookup', 'enriched_description')) GROUP BY 1, 2")
def sv_l09_augmented(spark: SparkSession, folder: str) -> DataFrame:
    """What a model adds to a rule's result: only categories that it may add, only where the text is long enough, and no more
    than a cap (L09)."""
    allowed = spark.createDataFrame([("roster_lookup",), ("enriched_description",)], "source string")
    e = table(spark, folder, "founder_company_edges").where(F.length(F.trim(F.coalesce("evidence", F.lit("")))) >= 20)
    return answers.augmented(e.select(F.col("company_id").alias("id"), "source", F.when(F.col("confidence") >= 0.8, 2.0).otherwise(1.0).alias("points")), allowed, ["id", "source"], "source", "points", 3.5)


@query("SELECT status, count(*) AS calls, CAST(sum(n_in) AS BIGINT) AS n_in, round(sum(n_in * 3.0 + n_out * 15.0) / 1000000, 6) AS cost FROM (SELECT CASE WHEN length(t) < 20 THEN 'short' ELSE 'dry_run' END AS status, CASE WHEN length(t) < 20 THEN 0 ELSE (9 + length(t)) // 4 END AS n_in, CASE WHEN length(t) < 20 THEN 0 ELSE 133 END AS n_out FROM (SELECT trim(coalesce(summary, '')) AS t FROM companies)) GROUP BY 1")
def sv_l03_estimate(spark: SparkSession, folder: str) -> DataFrame:
    """Calls, tokens and cost before any call is made."""
    log = call_model(table(spark, folder, "companies").select("id", F.trim("summary").alias("summary")), "id", ["summary"], "Classify.\n---USER---\n{{summary}}", _MODEL, least_text=20, dry_run=True)
    return costs(log, 3.0, 15.0).select("status", "calls", "n_in", F.round("cost", 6).alias("cost"))


@query("SELECT sub_sector, string_agg('{\"input\":{\"name\":\"' || name || '\"},\"output\":{\"label\":\"' || sub_sector || '\"}}', chr(10) ORDER BY last_updated_at DESC, id) AS examples FROM (SELECT id, sub_sector, regexp_replace(name, '[\"\\\\]', '', 'g') AS name, last_updated_at FROM companies WHERE sub_sector IS NOT NULL AND name IS NOT NULL AND venture_scale_confidence = 'HIGH' AND last_updated_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sub_sector ORDER BY last_updated_at DESC, id) <= 5) GROUP BY 1")
def sv_l12_examples(spark: SparkSession, folder: str) -> DataFrame:
    """The five latest validated examples of each class, as lines for a prompt."""
    c = table(spark, folder, "companies").where("name is not null and venture_scale_confidence = 'HIGH' and last_updated_at is not null")
    c = c.select("id", "sub_sector", F.regexp_replace("name", r'["\\]', "").alias("name"), "last_updated_at").where("sub_sector is not null")
    shown = answers.examples(c, "sub_sector", [F.desc("last_updated_at"), F.col("id")], 5, F.struct("name"), F.struct(F.col("sub_sector").alias("label")))
    return shown.select("sub_sector", F.array_join("examples", "\n").alias("examples"))


@query("SELECT id, name, version FROM (SELECT id, name, CASE WHEN length(name) % 2 = 0 THEN 'v2' ELSE 'v1' END AS version FROM companies WHERE name IS NOT NULL)")
def sv_l14_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Prompts of two versions read from the package's files and filled for every company; the version is in the text (L04, L14,
    S23)."""
    from corvane.model_calls.library import prompt_text, versions

    texts = {v: prompt_text("classify", v) for v in versions("classify")}
    filled = answers.filled(texts, {"name": F.col("name")}, F.when(F.length("name") % 2 == 0, "v2").otherwise("v1"))
    df = table(spark, folder, "companies").where("name is not null").select("id", "name", filled.alias("p"))
    found = F.regexp_extract("p", r"^Version (v[0-9])", 1)
    return df.where(F.col("p").endswith(F.col("name"))).select("id", "name", found.alias("version"))


@query("WITH r AS (SELECT source, id, success, row_number() OVER (PARTITION BY source ORDER BY id) AS n, sum(CAST(coalesce(success, 0) = 0 AS INTEGER)) OVER (PARTITION BY source ORDER BY id) AS f FROM harvest_runs) SELECT source, count(*) AS n_runs, CAST(max(f) AS BIGINT) AS n_failed, round(max(f / n), 6) AS worst_rate, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FILTER (n <= 12) AS sample FROM r GROUP BY source")
def sv_a11_running_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of the runs of each source with the highest running failure rate and up to twelve samples."""
    runs = table(spark, folder, "harvest_runs").select("source", "id", (F.coalesce("success", F.lit(0)) == 0).alias("failed"))
    out = passes.running_summary(runs, "source", F.col("id"), F.col("failed"), 12)
    return out.select("source", "n_runs", "n_failed", F.round("worst_rate", 6).alias("worst_rate"), F.array_join(F.transform("sample", lambda x: x.cast("string")), ",").alias("sample"))


@query("SELECT company_id, count(*) AS n, string_agg(founder, '|' ORDER BY founder) AS founders FROM (SELECT DISTINCT company_id, lower(trim(founder_name)) AS founder FROM founder_company_edges WHERE trim(founder_name) <> '') GROUP BY 1")
def sv_a16_members(spark: SparkSession, folder: str) -> DataFrame:
    """Members of each company with their total."""
    e = table(spark, folder, "founder_company_edges").where("trim(founder_name) <> ''").select("company_id", F.lower(F.trim("founder_name")).alias("founder")).distinct()
    return e.groupBy("company_id").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("founder")), "|").alias("founders"))


@query("SELECT source_name, pass_rate, n, rank FROM (SELECT source_name, round(avg(pass_rate), 6) AS pass_rate, count(*) AS n, row_number() OVER (ORDER BY round(avg(pass_rate), 6) DESC, source_name) AS rank FROM source_run_stats WHERE pass_rate BETWEEN 0 AND 1 AND NOT isnan(pass_rate) AND source_name IS NOT NULL GROUP BY 1) WHERE rank <= 10")
def sv_w06_best_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The ten sources of the highest mean pass rate: a top-k report."""
    s = table(spark, folder, "source_run_stats").where("pass_rate between 0 and 1 and not isnan(pass_rate) and source_name is not null")
    top = s.groupBy("source_name").agg(F.round(F.avg("pass_rate"), 6).alias("pass_rate"), F.count("*").alias("n"))
    return passes.ranked_report(top, [F.desc("pass_rate"), F.col("source_name")], 10)


@query("SELECT DISTINCT lower(trim(event_type)) AS event_type, user_id FROM events")
def sv_x_stream_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first event of each user and type as a stream, deduplicated with a watermark longer than the data; written to files."""
    place = _place(spark)
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    first = first_within(stream.withColumn("event_type", F.lower(F.trim("event_type"))), "ts", ["event_type", "user_id"], "4000 days")
    first.select("event_type", "user_id").writeStream.format("parquet").option("path", place).option("checkpointLocation", f"{place}-state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_type string, user_id bigint").parquet(place)
