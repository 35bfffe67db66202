"""Survey queries of scopes (P), summaries (A), stores that are written and read again (K, S), lookups (S15 to S17) and stages
(X), over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane import pipeline
from corvane.functions import text as tx
from corvane.model_calls.map import add_known
from corvane.operators import lookup, resolve, store
from corvane.operators.snapshot_diff import as_set
from corvane.plans.common import table
from corvane.plans.functions_sql import _end_sql, _slug_sql
from corvane.plans.relations_sql import _RESOLVE_SQL
from corvane.scratch import scratch_dir
from corvane.sources import feeds
from corvane.sources.paged import candidate_pages, first_platform, lookup_first

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _valid() -> Column:
    return F.col("venture_scale_score").between(0, 10) & ~F.isnan("venture_scale_score")


def _place(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/store-{uuid.uuid4().hex}"


@query("SELECT '24INR' || lpad(CAST(id % 10000 AS VARCHAR), 4, '0') AS number, id FROM raw_records WHERE upper(trim(string_split(location_raw, ',')[1])) = 'HOUSTON' AND trim(name_raw) <> '' AND (snapshot_no <> 1 OR contains(upper(coalesce(tags, '')), 'IA'))")
def sv_p02_queue(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a queue by number, zone, entity and phase (S14's filter)."""
    raw = table(spark, folder, "raw_records")
    rows = raw.select("id", F.concat(F.lit("24INR"), F.lpad((F.col("id") % 10000).cast("string"), 4, "0")).alias("number"), F.get(F.split("location_raw", ","), F.lit(0)).alias("zone"), F.col("name_raw").alias("entity"), F.col("tags").alias("phase"), F.when(F.col("snapshot_no") == 1, "Large").otherwise("Small").alias("sheet"))
    return feeds.queue_rows(rows, "HOUSTON", "Large").select("number", "id")


@query("SELECT id, venture_scale_score FROM companies WHERE is_duplicate = 0 AND venture_scale_score BETWEEN 0 AND 10 AND NOT isnan(venture_scale_score) AND (sub_sector IS NULL OR summary IS NULL OR founder_names IS NULL)")
def sv_p07_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Companies that a later pass has work for."""
    c = table(spark, folder, "companies")
    return c.where((F.col("is_duplicate") == 0) & _valid() & (F.col("sub_sector").isNull() | F.col("summary").isNull() | F.col("founder_names").isNull())).select("id", "venture_scale_score")


@query("SELECT left_id AS id, CAST(coalesce(bool_or(c.sub_sector IS NULL), true) AS INTEGER) AS needs_sector, CAST(coalesce(bool_or(c.summary IS NULL), true) AS INTEGER) AS needs_summary FROM match_pairs p LEFT JOIN companies c ON c.id = p.left_id GROUP BY left_id")
def sv_p08_needs(spark: SparkSession, folder: str) -> DataFrame:
    """What is missing of each matched row; everything, where the row does not exist."""
    c = table(spark, folder, "companies").select("id", F.col("sub_sector").isNull().alias("a"), F.col("summary").isNull().alias("b"))
    ids = table(spark, folder, "match_pairs").select(F.col("left_id").alias("id")).distinct()
    return lookup.attach(ids, c, ["id"]).select("id", F.coalesce("a", F.lit(True)).cast("int").alias("needs_sector"), F.coalesce("b", F.lit(True)).cast("int").alias("needs_summary"))


@query("SELECT id FROM companies WHERE (founder_names IS NULL OR founder_names = '' OR founder_names NOT ILIKE '%an%') AND venture_scale_score >= 4 AND (sub_sector <> 'off_thesis' OR sub_sector IS NULL)")
def sv_p11_scope(spark: SparkSession, folder: str) -> DataFrame:
    """A scope with a negated, case-insensitive pattern and explicit NULLs."""
    c = table(spark, folder, "companies")
    bare = tx.absent("founder_names") | ~F.col("founder_names").ilike("%an%")
    return c.where(bare & (F.col("venture_scale_score") >= 4) & ((F.col("sub_sector") != "off_thesis") | F.col("sub_sector").isNull())).select("id")


@query("SELECT count(*) AS n, count(*) FILTER (s.n IS NOT NULL) AS n_known FROM raw_records r LEFT JOIN (SELECT DISTINCT lower(trim(source_name)) AS n FROM source_registry) s ON s.n = lower(trim(r.source))")
def sv_p12_known_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Records of registered and of unknown sources."""
    known = table(spark, folder, "source_registry").select(F.lower(F.trim("source_name")).alias("s")).distinct().withColumn("k", F.lit(True))
    raw = table(spark, folder, "raw_records").select(F.lower(F.trim("source")).alias("s"))
    return raw.join(known, "s", "left").agg(F.count("*").alias("n"), F.count("k").alias("n_known"))


@query("SELECT coalesce(sub_sector, '?') AS line, count(*) AS n, count(*) FILTER (founder_names LIKE '[%') AS n_named, count(*) FILTER (website IS NULL) AS n_offline, min(name) AS sample FROM companies GROUP BY 1")
def sv_a10_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Counters and a sample of each line of business in one pass."""
    c = table(spark, folder, "companies")
    return c.groupBy(F.coalesce("sub_sector", F.lit("?")).alias("line")).agg(F.count("*").alias("n"), F.count_if(F.col("founder_names").startswith("[")).alias("n_named"), F.count_if(F.col("website").isNull()).alias("n_offline"), F.min("name").alias("sample"))


@query(f"WITH RECURSIVE {_RESOLVE_SQL}, n AS (SELECT count(*) AS n FROM companies), k AS (SELECT count(*) AS members, count(DISTINCT component) AS merges FROM comp), u AS (SELECT coalesce(sum(m), 0) AS domain_unions FROM (SELECT count(*) - 1 AS m FROM doms WHERE d IS NOT NULL GROUP BY d)) SELECT n.n AS before_count, n.n - (k.members - k.merges) AS after_count, k.members - k.merges AS duplicates, k.merges, CAST(u.domain_unions AS BIGINT) AS domain_unions FROM n, k, u")
def sv_a12_resolution(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of a resolution: before, after, merges, unions by domain."""
    c = table(spark, folder, "companies")
    df = c.select("id", tx.match_name("name").alias("n"), tx.bare_domain("canonical_domain").alias("d"), as_set(F.col("source_ids")).alias("s"))
    found = resolve.resolve(df, row="id", name="n", domain="d", sources="s", order=[F.lit(0)])
    return resolve.resolution_summary(found, df, "d", "id")


_SRC_SQL = "list_sort(list_distinct(list_transform(coalesce(CAST(try_cast(source_ids AS JSON) AS VARCHAR[]), CASE WHEN trim(source_ids) <> '' THEN [trim(source_ids)] ELSE [] END), lambda x: trim(x))))"


@query(f"SELECT canonical, string_agg(x, '|' ORDER BY id, p) AS merged FROM (SELECT coalesce(nullif(lower(trim(canonical_id)), ''), id) AS canonical, id, u.x, u.p FROM companies, unnest({_SRC_SQL}) WITH ORDINALITY AS u(x, p) QUALIFY row_number() OVER (PARTITION BY coalesce(nullif(lower(trim(canonical_id)), ''), id), u.x ORDER BY id, u.p) = 1) GROUP BY 1")
def sv_a13_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Sources of all rows of a group, in row order, without repetition."""
    c = table(spark, folder, "companies").select("id", "canonical_id", as_set(F.col("source_ids")).alias("s"))
    groups = c.select("id", F.coalesce(F.nullif(F.lower(F.trim("canonical_id")), F.lit("")), "id").alias("canonical"))
    return resolve.merged_sources(c.drop("canonical_id"), groups, "id", "s").select("canonical", F.array_join("merged", "|").alias("merged"))


@query("SELECT id, CAST(coalesce(len(list_filter(CAST(try_cast(founder_names AS JSON) AS VARCHAR[]), lambda x: contains(x, ' J'))) > 0, false) AS INTEGER) AS any_j FROM companies")
def sv_a18_any(spark: SparkSession, folder: str) -> DataFrame:
    """Whether any element of an array fits."""
    names = F.from_json("founder_names", "array<string>")
    return table(spark, folder, "companies").select("id", F.coalesce(F.exists(names, lambda x: x.contains(" J")), F.lit(False)).cast("int").alias("any_j"))


@query("SELECT lower(trim(canonical_id)) AS component, id AS canonical FROM companies WHERE trim(canonical_id) <> '' QUALIFY row_number() OVER (PARTITION BY lower(trim(canonical_id)) ORDER BY CASE WHEN venture_scale_score BETWEEN 0 AND 10 AND NOT isnan(venture_scale_score) THEN venture_scale_score ELSE 0 END DESC, coalesce(first_seen_at, '9999'), id) = 1")
def sv_w01_canonical(spark: SparkSession, folder: str) -> DataFrame:
    """The canonical row of each group, by score, first sighting and id."""
    c = table(spark, folder, "companies").where("trim(canonical_id) <> ''")
    score = F.when(_valid(), F.col("venture_scale_score")).otherwise(F.lit(0.0))
    return lookup.best(c, {"component": F.lower(F.trim("canonical_id"))}, [-score, F.coalesce("first_seen_at", F.lit("9999")), F.col("id")], ["id"]).withColumnRenamed("id", "canonical")


@query("SELECT id, CASE WHEN regexp_matches(harvested_at, '^[0-9]{4}-[0-9]{2}-[0-9]{2}T') THEN substr(harvested_at, 1, 10) END AS day FROM raw_records")
def sv_f33_iso_day(spark: SparkSession, folder: str) -> DataFrame:
    """Day of a time in ISO form, else NULL."""
    return table(spark, folder, "raw_records").select("id", F.date_format(F.try_to_timestamp("harvested_at", F.lit("yyyy-MM-dd'T'HH:mm:ssX")), "yyyy-MM-dd").alias("day"))


@query("SELECT id, CASE venture_scale_confidence WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END AS r FROM companies")
def sv_f35_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Rank of an ordinal label."""
    ranks = F.create_map(*[F.lit(x) for x in ("HIGH", 3, "MEDIUM", 2, "LOW", 1)])
    return table(spark, folder, "companies").select("id", F.coalesce(F.try_element_at(ranks, F.coalesce("venture_scale_confidence", F.lit(""))), F.lit(0)).alias("r"))


@query("SELECT id, 'Known: ' || array_to_string(CAST(try_cast(founder_names AS JSON) AS VARCHAR[]), ', ') AS context FROM companies WHERE founder_names LIKE '[%'")
def sv_f44_context(spark: SparkSession, folder: str) -> DataFrame:
    """Context line for a prompt."""
    c = table(spark, folder, "companies").where("founder_names like '[%'")
    return c.select("id", F.concat(F.lit("Known: "), F.array_join(F.from_json("founder_names", "array<string>"), ", ")).alias("context"))


@query("SELECT company_id, array_to_string(list_sort(list_distinct(list(lower(trim(founder_name)) || '/' || coalesce(nullif(trim(evidence), ''), 'Co-founder')))), '|') AS founders FROM founder_company_edges WHERE founder_name IS NOT NULL GROUP BY 1")
def sv_f45_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Structs with a default for a blank field."""
    e = table(spark, folder, "founder_company_edges").where("founder_name is not null")
    one = F.concat(F.lower(F.trim("founder_name")), F.lit("/"), F.coalesce(F.nullif(F.trim("evidence"), F.lit("")), F.lit("Co-founder")))
    return e.groupBy("company_id").agg(F.array_join(F.array_sort(F.collect_set(one)), "|").alias("founders"))


@query("SELECT id, len(CAST(try_cast(source_ids AS JSON) AS VARCHAR[])) AS n_hits, trim(CAST(try_cast(source_ids AS JSON) AS VARCHAR[])[1]) AS first_hit FROM companies WHERE source_ids LIKE '[\"%'")
def sv_s15_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Per-key lookup in landed responses: number of hits and the first."""
    c = table(spark, folder, "companies").where("source_ids like '[\"%'")
    names = F.from_json("source_ids", "array<string>")
    body = F.to_json(F.struct(F.lit(True).alias("success"), F.transform(names, lambda x: F.struct(F.trim(x).alias("name"))).alias("data")))
    out = lookup_first(c.select("id"), c.select("id", body.alias("body")), "id", "struct<name:string>")
    return out.select("id", F.col("n_hits").cast("long").alias("n_hits"), F.col("first_hit.name").alias("first_hit"))


@query("SELECT id, CASE WHEN website LIKE 'http%' THEN 'website' WHEN canonical_domain LIKE '%.%' THEN 'domain' ELSE 'name' END AS platform FROM companies")
def sv_s16_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """The first of three lookups that has an answer."""
    c = table(spark, folder, "companies")
    parts = [c.where("website like 'http%'").select("id", F.lit("website").alias("platform")), c.where("canonical_domain like '%.%'").select("id", F.lit("domain").alias("platform")), c.select("id", F.lit("name").alias("platform"))]
    return first_platform(parts, "id").select("id", "platform")


@query("SELECT 'https://' || id AS site, 'https://' || id || CASE WHEN length(name) % 3 = 0 THEN '/about' ELSE '/team' END AS url FROM companies WHERE length(name) % 3 < 2")
def sv_s17_candidate_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The first of several paths whose page is good."""
    c = table(spark, folder, "companies").select(F.concat(F.lit("https://"), "id").alias("site"), (F.length("name") % 3).alias("k"))
    long = F.repeat(F.lit("text "), 200)
    pages = c.select(F.concat("site", F.lit("/about")).alias("url"), F.when(F.col("k") == 0, 200).otherwise(404).alias("status"), long.alias("text")).unionByName(c.select(F.concat("site", F.lit("/team")).alias("url"), F.lit(200).alias("status"), F.when(F.col("k") < 2, long).otherwise("short").alias("text")))
    return candidate_pages(c, pages, "site", ["/about", "/team"]).select("site", "url")


@query("SELECT id, name, venture_scale_score AS score FROM companies WHERE venture_scale_score BETWEEN 0 AND 10 AND NOT isnan(venture_scale_score) AND name IS NOT NULL")
def sv_s20_json_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of JSON, written and read again; invalid ones are skipped."""
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    path = _place(spark)
    store.save(table(spark, folder, "companies").where(F.col("name").isNotNull()).select("id", "name", F.when(~F.isnan("venture_scale_score"), F.col("venture_scale_score")).alias("score")), path, kind="json")
    spark.createDataFrame([("",), ("{broken",)], "value string").write.mode("append").text(path)
    schema = StructType([StructField("id", StringType()), StructField("name", StringType()), StructField("score", DoubleType())])
    return feeds.read_json_lines(spark, path, schema, "score between 0 and 10")


@query("SELECT source, snapshot_no, count(*) AS n, count(DISTINCT id) AS n_ids FROM raw_records GROUP BY 1, 2")
def sv_k02_append(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries appended one by one to a store that is partitioned by delivery."""
    path = _place(spark)
    raw = table(spark, folder, "raw_records").select("id", "source", "snapshot_no")
    store.save(raw.where("snapshot_no <= 2"), path, partition="snapshot_no")
    store.save(raw.where("snapshot_no > 2 or snapshot_no is null"), path, partition="snapshot_no")
    return spark.read.parquet(path).groupBy("source", "snapshot_no").agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))


@query("SELECT lower(trim(founder_name)) AS k, min(founder_name) AS canonical_name, count(DISTINCT company_id) AS n FROM founder_company_edges WHERE founder_name IS NOT NULL GROUP BY 1")
def sv_k14_structured(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension with its members as an array."""
    e = table(spark, folder, "founder_company_edges").where("founder_name is not null").withColumn("k", F.lower(F.trim("founder_name")))
    return store.structured(e, "k", "founder_name", ["company_id"]).select("k", "canonical_name", F.size("members").cast("long").alias("n"))


@query("SELECT id, trim(name) AS name FROM companies")
def sv_k16_export(spark: SparkSession, folder: str) -> DataFrame:
    """CSV export with a header, read again."""
    path = _place(spark)
    c = table(spark, folder, "companies").select("id", "name", F.from_json("source_ids", "array<string>").alias("sources"))
    pipeline.export(c, path)
    return spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path).select("id", "name")


@query("WITH e AS (SELECT DISTINCT company_id, lower(trim(founder_name)) AS f FROM founder_company_edges WHERE founder_name IS NOT NULL), c AS (SELECT id, coalesce(CAST(try_cast(founder_names AS JSON) AS VARCHAR[]), []) AS named FROM companies) SELECT id, array_to_string(list_concat(list_reverse(list_sort(coalesce(list(f) FILTER (NOT list_contains([lower(x) FOR x IN named], f)), []))), named), '|') AS founders FROM c JOIN e ON e.company_id = c.id GROUP BY id, named")
def sv_l10_add_known(spark: SparkSession, folder: str) -> DataFrame:
    """Known founders that a text does not name, in reverse before those it names."""
    e = table(spark, folder, "founder_company_edges").where("founder_name is not null").groupBy(F.col("company_id").alias("id")).agg(F.array_sort(F.collect_set(F.struct(F.lower(F.trim("founder_name")).alias("name")))).alias("known"))
    named = F.transform(F.coalesce(F.from_json("founder_names", "array<string>"), F.array().cast("array<string>")), lambda x: F.struct(x.alias("name")))
    c = table(spark, folder, "companies").select("id", named.alias("named"))
    return c.join(e, "id").select("id", F.array_join(F.transform(add_known(F.col("named"), F.col("known"), "name"), lambda x: x["name"]), "|").alias("founders"))


@query(f"SELECT k AS id, count(DISTINCT source) AS n_sources FROM (SELECT source, {_slug_sql(f"strip_accents(lower({_end_sql('name_raw')}))")} AS k FROM raw_records) WHERE k <> '' GROUP BY 1")
def sv_x03_consolidate(spark: SparkSession, folder: str) -> DataFrame:
    """The consolidation stage over all sightings."""
    raw = table(spark, folder, "raw_records").withColumnRenamed("id", "raw_id")
    return pipeline.consolidate(raw).select("id", F.size("source_ids").cast("long").alias("n_sources"))


@query("WITH e AS (SELECT DISTINCT lower(trim(founder_name)) AS f, company_id AS c FROM founder_company_edges), n AS (SELECT f, count(*) AS k FROM e GROUP BY 1) SELECT c AS id, count(*) FILTER (k > 1) AS n_repeat FROM e JOIN n USING (f) GROUP BY 1")
def sv_x08_prior(spark: SparkSession, folder: str) -> DataFrame:
    """How many founders of a company have another one: two aggregations over the edges, no self-join."""
    e = table(spark, folder, "founder_company_edges").select(F.lower(F.trim("founder_name")).alias("f"), F.col("company_id").alias("id")).distinct().where("f is not null")
    n = e.groupBy("f").agg(F.count("*").alias("k"))
    return e.join(n, "f").groupBy("id").agg(F.count_if(F.col("k") > 1).alias("n_repeat"))
