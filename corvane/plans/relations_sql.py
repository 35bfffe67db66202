"""Survey queries of joins (J), aggregates (A), windows (W), set operations (U), writers (K), resolution (D), rules and
scans, over whole tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.functions.similarity import gestalt_ratio, indel_ratio, may_reach, sorted_tokens
from corvane.operators import lookup, rank, resolve, rules, store
from corvane.operators.graph import components
from corvane.operators.snapshot_diff import as_set
from corvane.plans.common import table
from corvane.plans.functions_sql import _domain_sql, _match_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _names(c: str) -> Column:
    return F.lower(F.trim(F.col(c)))


@query("SELECT c.id, r.website AS latest_website FROM companies c LEFT JOIN (SELECT lower(trim(name_raw)) AS k, arg_max(coalesce(website, '\x01'), id) AS website FROM raw_records WHERE name_raw IS NOT NULL GROUP BY 1) q ON q.k = lower(trim(c.name)) LEFT JOIN (SELECT lower(trim(name_raw)) AS k, website FROM raw_records QUALIFY row_number() OVER (PARTITION BY lower(trim(name_raw)) ORDER BY id DESC) = 1) r ON r.k = lower(trim(c.name))")
def sv_j01_latest_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """The website of a company's latest sighting by name."""
    found = lookup.latest(table(spark, folder, "raw_records"), {"k": _names("name_raw")}, F.col("id"), ["website"])
    left = table(spark, folder, "companies").select("id", _names("name").alias("k"))
    return lookup.attach(left, found, ["k"]).select("id", F.col("website").alias("latest_website"))


@query("SELECT c.id, r.description FROM companies c LEFT JOIN (SELECT lower(trim(company_id)) AS k, description FROM raw_records WHERE company_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lower(trim(company_id)) ORDER BY id DESC) = 1) r ON r.k = c.id")
def sv_j02_latest_by_id(spark: SparkSession, folder: str) -> DataFrame:
    """The description of a company's latest sighting by identifier."""
    found = lookup.latest(table(spark, folder, "raw_records"), {"id": _names("company_id")}, F.col("id"), ["description"])
    return lookup.attach(table(spark, folder, "companies").select("id"), found, ["id"])


@query("SELECT id, source_name, run_date, round(try_cast(pass_rate AS DOUBLE), 6) AS pass_rate FROM source_run_stats s WHERE run_date = (SELECT max(run_date) FROM source_run_stats t WHERE t.source_name = s.source_name)")
def sv_j03_latest_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The runs at each source's latest date, ties kept."""
    df = lookup.newest_kept_with_ties(table(spark, folder, "source_run_stats"), "source_name", "run_date")
    return df.select("id", "source_name", "run_date", F.round("pass_rate", 6).alias("pass_rate"))


_PRIO_SQL = "(SELECT lower(trim(source_name)) AS s, min(trust_rank) AS p FROM source_registry GROUP BY 1)"


def _ranked_sites(spark: SparkSession, folder: str) -> DataFrame:
    prio = table(spark, folder, "source_registry").groupBy(_names("source_name").alias("s")).agg(F.min("trust_rank").alias("p"))
    raw = table(spark, folder, "raw_records").withColumn("url", tx.full_url("website")).where("url is not null")
    raw = raw.withColumn("s", _names("source")).join(prio, "s", "left").withColumn("p", F.coalesce("p", F.lit(10**6)))
    return lookup.best(raw, {"k": _names("name_raw")}, [F.col("p"), -F.col("id")], ["url", "source"])


_URL = "CASE WHEN contains(regexp_extract(u, '^[a-zA-Z]+://([^/?#]*)', 1), '.') THEN u END"
_SITES_SQL = f"sites AS (SELECT k, url, source FROM (SELECT lower(trim(name_raw)) AS k, id, source, {_URL} AS url, coalesce(p, 1000000) AS p FROM (SELECT *, CASE WHEN regexp_matches(rtrim(trim(website), '/'), '(?i)^https?://') THEN rtrim(trim(website), '/') ELSE 'https://' || rtrim(trim(website), '/') END AS u FROM raw_records) LEFT JOIN {_PRIO_SQL} q ON q.s = lower(trim(source))) WHERE url IS NOT NULL AND k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY p, id DESC) = 1)"


@query(f"WITH {_SITES_SQL} SELECT c.id, s.url, s.source FROM companies c LEFT JOIN sites s ON s.k = lower(trim(c.name)) WHERE c.canonical_domain IS NULL OR c.canonical_domain = ''")
def sv_j04_best_website(spark: SparkSession, folder: str) -> DataFrame:
    """Websites for companies without a domain, from the most trusted, then latest sighting."""
    left = table(spark, folder, "companies").where(tx.absent("canonical_domain")).select("id", _names("name").alias("k"))
    return lookup.attach(left, _ranked_sites(spark, folder), ["k"]).drop("k")


@query(f"WITH {_SITES_SQL}, f AS (SELECT s.source FROM companies c JOIN sites s ON s.k = lower(trim(c.name)) WHERE c.canonical_domain IS NULL OR c.canonical_domain = '') SELECT source, count(*) AS n FROM f GROUP BY 1")
def sv_a09_fill_summary(spark: SparkSession, folder: str) -> DataFrame:
    """How many domains each source would fill."""
    return sv_j04_best_website(spark, folder).where("url is not null").groupBy("source").agg(F.count("*").alias("n"))


@query("WITH d AS (SELECT c.id, r.description, r.id AS rid FROM companies c JOIN raw_records r ON lower(trim(r.company_id)) = c.id UNION SELECT c.id, r.description, r.id FROM companies c JOIN raw_records r ON lower(trim(r.name_raw)) = lower(trim(c.name))) SELECT id, description FROM d WHERE description <> '' QUALIFY row_number() OVER (PARTITION BY id ORDER BY length(description) DESC, rid) = 1")
def sv_j05_longest_text(spark: SparkSession, folder: str) -> DataFrame:
    """The longest description of a company, by identifier or by name: two equi-joins, no OR."""
    raw = table(spark, folder, "raw_records").where("description <> ''").select(F.col("id").alias("rid"), "description", _names("company_id").alias("cid"), _names("name_raw").alias("nm"))
    order = [-F.length("description"), F.col("rid")]
    # one row an identifier and one a name, before anything is joined
    by_id, by_name = [lookup.best(raw, {"k": F.col(c)}, order, ["rid", "description"]) for c in ("cid", "nm")]
    left = table(spark, folder, "companies").select("id", _names("name").alias("key_name"))
    both = left.join(by_id, F.col("id") == F.col("k")).select("id", "rid", "description").unionByName(left.join(by_name, F.col("key_name") == F.col("k")).select("id", "rid", "description"))
    return lookup.best(both, {"k": F.col("id")}, order, ["description"]).withColumnRenamed("k", "id")


@query("SELECT c.id, r.website AS fallback FROM companies c LEFT JOIN (SELECT name_raw, website FROM raw_records WHERE website IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name_raw ORDER BY id) = 1) r ON r.name_raw = c.name")
def sv_j06_first_website(spark: SparkSession, folder: str) -> DataFrame:
    """The earliest website under exactly the same name."""
    found = lookup.best(table(spark, folder, "raw_records").where("website is not null"), {"name": F.col("name_raw")}, [F.col("id")], ["website"])
    return lookup.attach(table(spark, folder, "companies").select("id", "name"), found, ["name"]).select("id", F.col("website").alias("fallback"))


def _closest(names: list[str], least: float):
    @F.pandas_udf("string")
    def best(values: pd.Series) -> pd.Series:
        import difflib

        def one(v):
            if v is None:
                return None
            top, found = least, None
            for n in names:
                r = difflib.SequenceMatcher(None, v, n).ratio()
                if r > top or (found is None and r >= top):
                    top, found = r, n
            return found

        return values.map(one)

    return best


@query()
def sv_j07_closest_source(spark: SparkSession, folder: str) -> DataFrame:
    """Source names as typed in companies to registered ones: equal, else the closest of 0.85 or more by Ratcliff-Obershelp
    ratio (F39). The registry is collected up to a bound of 10,000 names."""
    names = [r.s for r in table(spark, folder, "source_registry").select(_names("source_name").alias("s")).orderBy("s").limit(10_001).collect()]
    if len(names) > 10_000:
        raise ValueError("the registry is no small dimension")
    typed = table(spark, folder, "companies").select(F.explode(as_set(F.col("source_ids"))).alias("t")).select(F.lower("t").alias("typed")).distinct()
    return typed.withColumn("registered", F.when(F.col("typed").isin(names), F.col("typed")).otherwise(_closest(names, 0.85)(F.col("typed"))))


@query("WITH p AS (SELECT id, lower(trim(u.x)) AS founder FROM companies, unnest(CAST(try_cast(founder_names AS JSON) AS VARCHAR[])) AS u(x)), e AS (SELECT DISTINCT lower(trim(founder_name)) AS founder FROM founder_company_edges) SELECT id, count(*) AS n FROM p SEMI JOIN e USING (founder) GROUP BY id")
def sv_j08_known_founders(spark: SparkSession, folder: str) -> DataFrame:
    """Founders named by a company that the graph knows: a semi-join on exploded names."""
    people = table(spark, folder, "companies").select("id", F.explode(F.from_json("founder_names", "array<string>")).alias("f")).select("id", F.lower(F.trim("f")).alias("founder"))
    known = table(spark, folder, "founder_company_edges").select(_names("founder_name").alias("founder")).distinct()
    return people.join(known, "founder", "left_semi").groupBy("id").agg(F.count("*").alias("n"))


_DOMAIN_SQL = r"(CASE WHEN contains(regexp_extract(regexp_replace(regexp_replace(rtrim(lower(trim(canonical_domain)), '/'), '^https?://', ''), '^www\.', ''), '^([^/?#]*)', 1), '.') THEN regexp_extract(regexp_replace(regexp_replace(rtrim(lower(trim(canonical_domain)), '/'), '^https?://', ''), '^www\.', ''), '^([^/?#]*)', 1) END)"


@query(f"WITH d AS (SELECT id, {_DOMAIN_SQL} AS dom FROM companies), m AS (SELECT dom, min(id) AS a FROM d WHERE dom IS NOT NULL GROUP BY 1) SELECT a, id AS b FROM d JOIN m USING (dom) WHERE a <> id")
def sv_j09_domain_stars(spark: SparkSession, folder: str) -> DataFrame:
    """Rows at one domain linked to the smallest of them."""
    return resolve.star_edges(table(spark, folder, "companies").withColumn("d", tx.bare_domain("canonical_domain")), "d", "id")


#: Rows of the edit distance and of the longest common subsequence, a step for each letter of x, over all letters of y.
_STEPS_SQL = """t AS (SELECT *, string_split(x, '') AS xs, string_split(y, '') AS ys FROM pairs WHERE x IS NOT NULL AND y IS NOT NULL),
s AS (SELECT k, len(CASE WHEN x = '' THEN [] ELSE xs END) AS nx, len(CASE WHEN y = '' THEN [] ELSE ys END) AS ny, xs, ys FROM t),
dp AS (SELECT k, nx, ny, xs, ys, 0 AS i, range(0, ny + 1) AS ed, [0 FOR j IN range(0, ny + 1)] AS lc FROM s
       UNION ALL SELECT k, nx, ny, xs, ys, i + 1,
         [j + list_min([CASE WHEN m = 0 THEN i + 1 ELSE least(ed[m + 1] + 1, ed[m] + CASE WHEN xs[i + 1] = ys[m] THEN 0 ELSE 1 END) - m END FOR m IN range(0, j + 1)]) FOR j IN range(0, ny + 1)],
         [list_max([CASE WHEN m = 0 THEN 0 WHEN xs[i + 1] = ys[m] THEN lc[m] + 1 ELSE lc[m + 1] END FOR m IN range(0, j + 1)]) FOR j IN range(0, ny + 1)]
       FROM dp WHERE i < nx),
done AS (SELECT k, nx, ny, ed[ny + 1] AS ed, lc[ny + 1] AS lc FROM dp WHERE i = nx)"""
_TOKENS_SQL = r"array_to_string(list_sort(string_split(trim(regexp_replace({0}, '\s+', ' ', 'g')), ' ')), ' ')"
_SRC_SQL = "list_sort(list_distinct(list_transform(coalesce(CAST(try_cast({0} AS JSON) AS VARCHAR[]), CASE WHEN trim({0}) <> '' THEN [trim({0})] ELSE [] END), lambda x: trim(x))))"
#: Links by name: blocked pairs of representatives with no source in common, 88 or more, and copies of what is linked.
_SIMILAR_SQL = f"""base AS (SELECT id, {_match_sql('name')} AS n, {_SRC_SQL.format('source_ids')} AS s FROM companies),
reps AS (SELECT n, s, min(id) AS g, count(*) AS c, {_TOKENS_SQL.format('n')} AS t FROM base WHERE n <> '' GROUP BY n, s),
blocked AS (SELECT *, '4:' || n[1:4] AS key FROM reps WHERE length(n) >= 4 UNION ALL SELECT *, 'w:' || string_split(n, ' ')[1] FROM reps WHERE length(string_split(n, ' ')[1]) >= 4),
cand AS (SELECT DISTINCT a.g AS a, b.g AS b, a.t AS x, b.t AS y FROM blocked a JOIN blocked b ON a.key = b.key AND a.g < b.g WHERE NOT list_has_any(a.s, b.s)
         AND 200 * least(length(a.t), length(b.t)) >= 88 * (length(a.t) + length(b.t))),
pairs AS (SELECT DISTINCT hash(x, y) AS k, x, y FROM cand WHERE strlen(x) <> length(x) OR strlen(y) <> length(y) OR levenshtein(x, y) <= 0.12 * (length(x) + length(y))),
{_STEPS_SQL},
near AS (SELECT a, b FROM cand JOIN done ON done.k = hash(x, y) WHERE nx + ny > 0 AND 200.0 * lc / (nx + ny) >= 88),
linked AS (SELECT a AS g FROM near UNION SELECT b FROM near UNION SELECT g FROM reps WHERE len(s) = 0 AND c > 1),
by_name AS (SELECT a, b FROM near UNION ALL SELECT r.g, base.id FROM base JOIN reps r ON r.n = base.n AND r.s = base.s JOIN linked USING (g) WHERE r.g <> base.id)"""


@query(f"WITH RECURSIVE {_SIMILAR_SQL} SELECT a, b FROM by_name")
def sv_j10_similar_names(spark: SparkSession, folder: str) -> DataFrame:
    """Blocked similarity join of company names, 88 or more, no source in common."""
    from corvane.scratch import Scratch

    df = table(spark, folder, "companies").select("id", tx.match_name("name").alias("n"), as_set(F.col("source_ids")).alias("s"))
    return resolve.similar_names(df, "n", "s", "id", 88.0, Scratch(spark))


@query("SELECT count(*) AS n FROM (SELECT DISTINCT lower(trim(company_id)) AS id FROM raw_records WHERE company_id IS NOT NULL) r ANTI JOIN companies USING (id)")
def sv_j11_new_companies(spark: SparkSession, folder: str) -> DataFrame:
    """Companies sighted that the catalogue lacks: an anti-join."""
    seen = table(spark, folder, "raw_records").where("company_id is not null").select(_names("company_id").alias("id")).distinct()
    return lookup.not_in(seen, table(spark, folder, "companies"), ["id"]).agg(F.count("*").alias("n"))


_ORDER = ["Blue Flare", "Marshlight", "Iron Teal"]


@query("SELECT id, coalesce(list_min(list_transform(coalesce(CAST(try_cast(source_ids AS JSON) AS VARCHAR[]), CASE WHEN trim(source_ids) <> '' THEN [trim(source_ids)] ELSE [] END), lambda n: CASE WHEN contains(lower(n), 'blue flare') OR contains('blue flare', lower(n)) THEN 0 WHEN contains(lower(n), 'marshlight') OR contains('marshlight', lower(n)) THEN 1 WHEN contains(lower(n), 'iron teal') OR contains('iron teal', lower(n)) THEN 2 END)), 999) AS priority FROM companies")
def sv_j12_source_priority(spark: SparkSession, folder: str) -> DataFrame:
    """Priority of a company's sources by substring either way."""
    return table(spark, folder, "companies").select("id", lookup.priority_of(as_set(F.col("source_ids")), _ORDER).alias("priority"))


_ALIASES = [("energy", ["power", "energy", "fuels"]), ("carbon", ["carbon", "sorbents"]), ("water", ["desalination", "water"])]


@query("SELECT id, CASE WHEN t = '' THEN NULL WHEN " + " WHEN ".join(" OR ".join(f"contains(t, '{a}') OR contains('{a}', t)" for a in al) + f" THEN '{n}'" for n, al in _ALIASES) + " END AS line FROM (SELECT id, lower(trim(name)) AS t FROM companies)")
def sv_j13_first_alias(spark: SparkSession, folder: str) -> DataFrame:
    """The first canonical word whose aliases a name holds, or the other way round (J14 as well)."""
    return table(spark, folder, "companies").select("id", lookup.first_listed(F.col("name"), _ALIASES).alias("line"))


@query("SELECT lower(trim(founder_name)) AS founder, count(DISTINCT company_id) AS n_companies FROM founder_company_edges GROUP BY 1 HAVING count(DISTINCT company_id) > 1")
def sv_j15_founder_companies(spark: SparkSession, folder: str) -> DataFrame:
    """Founders with more than one company (X08's edge lookup)."""
    e = table(spark, folder, "founder_company_edges").groupBy(_names("founder_name").alias("founder")).agg(F.count_distinct("company_id").alias("n_companies"))
    return e.where("n_companies > 1")


@query("SELECT count(*) AS n, count(*) FILTER (is_duplicate = 1) AS n_duplicate, count(*) FILTER (venture_scale_score IS NOT NULL) AS n_scored, count(*) FILTER (summary IS NULL OR summary = '') AS n_bare FROM companies")
def sv_a01_status(spark: SparkSession, folder: str) -> DataFrame:
    """Status counts in one pass."""
    return table(spark, folder, "companies").agg(F.count("*").alias("n"), F.count_if(F.col("is_duplicate") == 1).alias("n_duplicate"), F.count_if(F.col("venture_scale_score").isNotNull()).alias("n_scored"), F.count_if(tx.absent("summary")).alias("n_bare"))


@query("SELECT id, round(venture_scale / nullif(total_records, 0), 6) AS a, round(manually_demoted / nullif(venture_scale, 0), 6) AS b, round(manually_promoted / nullif(borderline + not_venture_scale, 0), 6) AS c FROM source_run_stats")
def sv_a04_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rates of runs, NULL for a zero denominator."""
    r = store.run_rates(table(spark, folder, "source_run_stats"))
    return r.select("id", F.round("r_pass", 6).alias("a"), F.round("r_false_positive", 6).alias("b"), F.round("r_false_negative", 6).alias("c"))


_SIGNALS_SQL = "list_filter([CASE WHEN canonical_domain LIKE '%.%' THEN 2.0 END, CASE WHEN summary <> '' THEN 1.0 END, CASE WHEN is_duplicate = 1 THEN 0.0 END], lambda x: x IS NOT NULL)"


def _signals() -> Column:
    return rules.fired(
        [
            rules.Signal("domain", F.col("canonical_domain").contains("."), 2, "HIGH", F.col("canonical_domain")),
            rules.Signal("summary", F.col("summary") != "", 1, "LOW", F.lit("text")),
            rules.Signal("duplicate", F.col("is_duplicate") == 1, 1, "LOW", F.lit("flag"), F.lit(True), "duplicate_row"),
        ]
    )


@query(f"SELECT id, CAST(coalesce(list_sum({_SIGNALS_SQL}), 0.0) AS DOUBLE) AS points, CAST(canonical_domain LIKE '%.%' IS TRUE AS INTEGER) AS n_high, CAST(coalesce(is_duplicate = 1, false) AS INTEGER) AS flagged, CASE WHEN coalesce(list_sum({_SIGNALS_SQL}), 0) >= 3 THEN 'full' WHEN coalesce(list_sum({_SIGNALS_SQL}), 0) >= 1 THEN 'part' ELSE 'bare' END AS band FROM companies")
def sv_a05_signals(spark: SparkSession, folder: str) -> DataFrame:
    """Additive signals as data: weighted sum, count by category, flags, bands (H-style scoring without its business rules)."""
    df = table(spark, folder, "companies").withColumn("s", _signals())
    points = rules.total(F.col("s"))
    return df.select("id", points.alias("points"), rules.counted(F.col("s"), "HIGH").alias("n_high"), rules.flagged(F.col("s")).cast("int").alias("flagged"), rules.band(points, [(3, "full"), (1, "part")], "bare").alias("band"))


@query("SELECT id, round(least(x, 3.5) + least(y, 3.5), 6) AS a, round(least((1.0 + x / 10) * (1.0 + y / 10), 1.8), 6) AS b FROM (SELECT id, coalesce(confidence, 0.0) AS x, length(founder_name) / 2.0 AS y FROM founder_company_edges)")
def sv_a06_capped(spark: SparkSession, folder: str) -> DataFrame:
    """Capped sum and capped product over an array."""
    v = F.array(F.coalesce("confidence", F.lit(0.0)), F.length("founder_name") / 2.0)
    return table(spark, folder, "founder_company_edges").select("id", F.round(rules.capped_sum(v, 3.5), 6).alias("a"), F.round(rules.capped_product(F.transform(v, lambda x: 1.0 + x / 10), 1.8), 6).alias("b"))


@query("WITH j AS (SELECT *, coalesce(regexp_matches(lower(location_raw), 'houston|katy'), false) AS l FROM raw_records), t AS (SELECT source, string_agg(name_raw, '|' ORDER BY id) AS titles FROM (SELECT * FROM j WHERE l QUALIFY row_number() OVER (PARTITION BY source ORDER BY id) <= 10) GROUP BY source) SELECT j.source, count(*) AS n_jobs, count(*) FILTER (l) AS n_local, min(t.titles) AS titles FROM j LEFT JOIN t ON t.source = j.source GROUP BY j.source")
def sv_a08_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Rollup of each source's sightings: all, local, the first ten local names."""
    from corvane.sources.paged import job_rollup

    jobs = table(spark, folder, "raw_records").select("source", F.coalesce("name_raw", F.lit("")).alias("name_raw"), "location_raw", F.col("id").alias("seq"))
    return job_rollup(jobs, "source", "name_raw", "location_raw", ["houston", "katy"]).select("source", "n_jobs", "n_local", F.array_join("titles", "|").alias("titles"))


@query("SELECT k AS id, name_raw, string_agg(source, '|' ORDER BY source) AS sources FROM (SELECT DISTINCT k, source, first_value(name_raw) OVER (PARTITION BY k ORDER BY id) AS name_raw FROM (SELECT id, source, name_raw, trim(regexp_replace(lower(name_raw), '[^a-z0-9]+', '-', 'g'), '-') AS k FROM raw_records) WHERE k <> '') GROUP BY 1, 2")
def sv_a14_first_sighting(spark: SparkSession, folder: str) -> DataFrame:
    """One company a slug: the first sighting's name and all sources."""
    raw = table(spark, folder, "raw_records").select("id", "source", "name_raw", tx.slug("name_raw").alias("k")).where("k <> ''")
    return raw.groupBy(F.col("k").alias("id")).agg(F.min_by("name_raw", "id").alias("name_raw"), F.array_join(F.array_sort(F.collect_set("source")), "|").alias("sources"))


@query("SELECT source, company_id, string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) AS deliveries FROM (SELECT DISTINCT source, lower(trim(company_id)) AS company_id, snapshot_no AS v FROM raw_records WHERE company_id IS NOT NULL) GROUP BY 1, 2")
def sv_a15_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """The deliveries in which a record occurs, in order."""
    raw = table(spark, folder, "raw_records").where("company_id is not null").select("source", _names("company_id").alias("company_id"), F.col("snapshot_no").alias("v"))
    return raw.groupBy("source", "company_id").agg(F.array_join(F.array_sort(F.collect_set("v")), ",").alias("deliveries"))


@query("SELECT lang, count(*) AS calls, CAST(sum(floor(length(text) / 4)) AS BIGINT) AS n_in, round(sum(floor(length(text) / 4) * 3.0 + 133 * 15.0) / 1000000, 6) AS cost FROM documents WHERE text IS NOT NULL GROUP BY lang")
def sv_a17_costs(spark: SparkSession, folder: str) -> DataFrame:
    """Cost of calling a model on every document, by language."""
    df = table(spark, folder, "documents").where("text is not null").withColumn("n", tx.estimated_tokens("text"))
    return df.groupBy("lang").agg(F.count("*").alias("calls"), F.sum("n").alias("n_in"), F.round(F.sum(F.col("n") * 3.0 + 133 * 15.0) / 1_000_000, 6).alias("cost"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY id) AS n, sum(CAST(success = 0 AS INTEGER)) OVER (PARTITION BY source ORDER BY id) AS f FROM (SELECT id, source, coalesce(success, 0) AS success FROM harvest_runs)), s AS (SELECT source, min(n) AS stop FROM r WHERE success = 0 AND n >= 10 AND f >= 0.1 * n GROUP BY 1) SELECT r.id, r.source FROM r LEFT JOIN s ON s.source IS NOT DISTINCT FROM r.source WHERE s.stop IS NULL OR r.n <= s.stop")
def sv_w02_cut_at_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of a source up to where failures reach a tenth of ten or more."""
    runs = table(spark, folder, "harvest_runs").select("id", "source", F.coalesce("success", F.lit(0)).alias("success"))
    return rank.cut_at_rate(runs, "source", F.col("id"), F.col("success") == 0, 0.1, 10).select("id", "source")


@query(f"SELECT id, dom FROM (SELECT id, {_DOMAIN_SQL} AS dom FROM companies) QUALIFY dom IS NULL OR row_number() OVER (PARTITION BY dom ORDER BY id) = 1")
def sv_w03_first_per_host(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of each domain; rows without one all stay."""
    df = table(spark, folder, "companies").select("id", tx.bare_domain("canonical_domain").alias("dom"))
    return rank.first_per_key(df, F.col("dom"), [F.col("id")])


@query("SELECT source, id, rank FROM (SELECT source, id, row_number() OVER (PARTITION BY source ORDER BY length(description) DESC NULLS LAST, id) AS rank FROM raw_records) WHERE rank <= 6")
def sv_w04_top_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """The six longest descriptions of each source."""
    return rank.top_k_per_key(table(spark, folder, "raw_records"), "source", [F.length("description").desc_nulls_last(), F.col("id")], 6).select("source", "id", F.col("rank").cast("long").alias("rank"))


@query("SELECT id, name, venture_scale_score FROM companies WHERE venture_scale_score BETWEEN 0 AND 10 AND NOT isnan(venture_scale_score) ORDER BY venture_scale_score DESC, id LIMIT 20")
def sv_w07_top_report(spark: SparkSession, folder: str) -> DataFrame:
    """Top report by score (W06, W08, P07's order)."""
    df = table(spark, folder, "companies").where("venture_scale_score between 0 and 10 and not isnan(venture_scale_score)")
    return rank.top_k(df.select("id", "name", "venture_scale_score"), [F.desc("venture_scale_score"), F.col("id")], 20)


@query("SELECT id, CAST(row_number() OVER (ORDER BY venture_scale_score DESC NULLS LAST, id) <= 200 AS INTEGER) AS allowed FROM (SELECT id, CASE WHEN venture_scale_score BETWEEN 0 AND 10 AND NOT isnan(venture_scale_score) THEN venture_scale_score ELSE -1 END AS venture_scale_score FROM companies)")
def sv_w10_budget(spark: SparkSession, folder: str) -> DataFrame:
    """Which companies a budget of 200 calls covers, by score; the others stay, marked."""
    score = F.when(F.col("venture_scale_score").between(0, 10) & ~F.isnan("venture_scale_score"), F.col("venture_scale_score")).otherwise(F.lit(-1.0))
    return rank.within_budget(table(spark, folder, "companies").select("id", score.alias("s")), [-F.col("s"), F.col("id")], 200).select("id", F.col("allowed").cast("int").alias("allowed"))


@query("SELECT source, snapshot_no, count(*) AS n, CASE WHEN count(*) < 50 THEN 'low' WHEN count(*) > 600 THEN 'high' ELSE 'ok' END AS state FROM raw_records GROUP BY 1, 2")
def sv_w11_yield(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries that are smaller or larger than expected."""
    n = table(spark, folder, "raw_records").groupBy("source", "snapshot_no").agg(F.count("*").alias("n"))
    return n.withColumn("state", rank.yield_state(F.col("n"), F.lit("50-300")))


@query("SELECT 'stats' AS origin, run_id, source_name AS source, total_records AS n FROM source_run_stats UNION ALL SELECT 'runs', run_id, source, records_harvested FROM harvest_runs")
def sv_u01_union(spark: SparkSession, folder: str) -> DataFrame:
    """Both run tables under one schema."""
    a = table(spark, folder, "source_run_stats").select(F.lit("stats").alias("origin"), "run_id", F.col("source_name").alias("source"), F.col("total_records").alias("n"))
    return a.unionByName(table(spark, folder, "harvest_runs").select(F.lit("runs").alias("origin"), "run_id", "source", F.col("records_harvested").alias("n")))


@query(f"SELECT p.pair_id, CAST(list_has_any({_SRC_SQL.format('a.source_ids')}, {_SRC_SQL.format('b.source_ids')}) AS INTEGER) AS shared, array_to_string(list_sort(list_distinct(list_concat({_SRC_SQL.format('a.source_ids')}, {_SRC_SQL.format('b.source_ids')}))), '|') AS every, len(list_filter({_SRC_SQL.format('a.source_ids')}, lambda x: NOT list_contains({_SRC_SQL.format('b.source_ids')}, x))) AS only_left FROM match_pairs p JOIN companies a ON a.id = p.left_id JOIN companies b ON b.id = p.right_id")
def sv_u02_source_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Overlap, union and difference of the sources of matched rows."""
    c = table(spark, folder, "companies").select("id", as_set(F.col("source_ids")).alias("s"))
    m = table(spark, folder, "match_pairs").select("pair_id", "left_id", "right_id")
    both = m.join(c.select(F.col("id").alias("left_id"), F.col("s").alias("a")), "left_id").join(c.select(F.col("id").alias("right_id"), F.col("s").alias("b")), "right_id")
    return both.select("pair_id", F.coalesce(F.arrays_overlap("a", "b"), F.lit(False)).cast("int").alias("shared"), F.array_join(F.array_sort(F.array_union("a", "b")), "|").alias("every"), F.size(F.array_except("a", "b")).cast("long").alias("only_left"))


@query("SELECT lower(trim(founder_name)) AS founder_name, company_id, arg_min(source, id) AS source, coalesce(arg_min(coalesce(confidence, -1), id), -1) AS confidence FROM founder_company_edges GROUP BY 1, 2")
def sv_k10_insert_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges inserted into an empty store: names normalised, the first of a key kept."""
    e = store.normalised_edges(table(spark, folder, "founder_company_edges").withColumn("confidence", F.coalesce("confidence", F.lit(-1.0))), "founder_name", lower=True)
    empty = spark.createDataFrame([], e.schema)
    return store.insert_or_ignore(empty, e, ["founder_name", "company_id"], F.col("id")).select("founder_name", "company_id", "source", "confidence")


@query("SELECT * FROM (SELECT id, run_id, source_name, load_no FROM source_run_stats s WHERE load_no < 12 AND NOT EXISTS (SELECT 1 FROM source_run_stats t WHERE t.load_no = 12 AND t.source_name = s.source_name)) UNION ALL SELECT id, run_id, source_name, load_no FROM source_run_stats WHERE load_no = 12")
def sv_k12_replace(spark: SparkSession, folder: str) -> DataFrame:
    """The last load replaces what earlier loads have of its sources."""
    df = table(spark, folder, "source_run_stats").select("id", "run_id", "source_name", "load_no")
    return store.insert_or_replace(df.where("load_no < 12"), df.where("load_no = 12"), ["source_name"])


@query("SELECT id, CASE WHEN summary IS NULL AND is_duplicate = 0 THEN upper(name) ELSE summary END AS summary FROM companies")
def sv_k04_update(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed update where a guard holds."""
    c = table(spark, folder, "companies")
    new = c.where("summary is null").select("id", F.upper("name").alias("summary"))
    return store.update_columns(c.select("id", "summary", "is_duplicate"), new, "id", ["summary"], F.col("is_duplicate") == 0).select("id", "summary")


@query("SELECT id, name, CAST(NULL AS VARCHAR) AS extra_note FROM companies")
def sv_k18_migrate(spark: SparkSession, folder: str) -> DataFrame:
    """Additive, idempotent schema migration."""
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField("name", StringType()), StructField("extra_note", StringType())])
    return store.migrate(store.migrate(table(spark, folder, "companies").select("id", "name"), schema), schema)


@query("SELECT company_id, array_to_string(list_transform(list_sort(list_distinct(list({'n': lower(trim(founder_name)), 's': coalesce(source, '')}))), lambda x: x.n || CASE WHEN x.s <> '' THEN ' (' || x.s || ')' ELSE '' END), '; ') AS cell FROM founder_company_edges GROUP BY 1")
def sv_k17_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Founders of a company as one spreadsheet cell."""
    e = table(spark, folder, "founder_company_edges").select("company_id", _names("founder_name").alias("n"), F.coalesce("source", F.lit("")).alias("s"))
    g = e.groupBy("company_id").agg(F.array_sort(F.collect_set(F.struct("n", "s", F.lit("").alias("note")))).alias("f"))
    return g.select("company_id", store.display_list(F.col("f"), "n", "s", "note").alias("cell"))


#: Resolution of all companies: stars of a domain, links by name, what reaches what, and the canonical row of each component.
_RESOLVE_SQL = f"""{_SIMILAR_SQL},
doms AS (SELECT id, {_domain_sql('canonical_domain')} AS d FROM companies),
stars AS (SELECT min(id) OVER (PARTITION BY d) AS a, id AS b FROM doms WHERE d IS NOT NULL QUALIFY a <> b),
links AS (SELECT a, b FROM stars UNION SELECT a, b FROM by_name), ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a),
comp AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a),
ranked AS (SELECT id, component, CASE WHEN venture_scale_score BETWEEN 0 AND 10 AND NOT isnan(venture_scale_score) THEN venture_scale_score ELSE 0.0 END AS score, coalesce(first_seen_at, '9999') AS seen FROM comp JOIN companies USING (id)),
at_domain AS (SELECT DISTINCT component FROM stars JOIN comp ON comp.id = stars.a)"""


@query(f"WITH RECURSIVE {_RESOLVE_SQL}, firsts AS (SELECT component, id AS canonical FROM ranked QUALIFY row_number() OVER (PARTITION BY component ORDER BY score DESC, seen, id) = 1) SELECT c.id, coalesce(f.canonical, c.id) AS canonical, CAST(coalesce(f.canonical <> c.id, false) AS INTEGER) AS is_duplicate, CASE WHEN f.canonical IS NULL THEN NULL WHEN a.component IS NOT NULL THEN 'domain' ELSE 'fuzzy_name' END AS match_type FROM companies c LEFT JOIN comp ON comp.id = c.id LEFT JOIN firsts f ON f.component = comp.component LEFT JOIN at_domain a ON a.component = comp.component")
def sv_d01_resolve(spark: SparkSession, folder: str) -> DataFrame:
    """Duplicates of all companies by domain and by name."""
    c = table(spark, folder, "companies")
    score = F.when(F.col("venture_scale_score").between(0, 10), F.col("venture_scale_score")).otherwise(F.lit(0.0))
    df = c.select("id", tx.match_name("name").alias("n"), tx.bare_domain("canonical_domain").alias("d"), as_set(F.col("source_ids")).alias("s"), F.coalesce(score, F.lit(0.0)).alias("score"), F.coalesce("first_seen_at", F.lit("9999")).alias("seen"))
    return resolve.resolve(df, row="id", name="n", domain="d", sources="s", order=[-F.col("score"), F.col("seen")])


@query("WITH RECURSIVE links AS (SELECT left_id AS a, right_id AS b FROM match_pairs WHERE lower(trim(dedup_match_type)) = 'domain' AND left_id <> right_id), w AS (SELECT a, b FROM links UNION SELECT b, a FROM links), reach AS (SELECT a, b FROM w UNION SELECT reach.a, w.b FROM reach JOIN w ON reach.b = w.a) SELECT a AS id, min(b) AS component FROM reach GROUP BY a")
def sv_d02_components(spark: SparkSession, folder: str) -> DataFrame:
    """Components of the domain matches."""
    m = table(spark, folder, "match_pairs").where(_names("dedup_match_type") == "domain")
    return components(m, "left_id", "right_id")


@query(f"WITH RECURSIVE m AS (SELECT p.pair_id, lower(trim(a.name)) AS x, lower(trim(b.name)) AS y FROM match_pairs p JOIN companies a ON a.id = p.left_id JOIN companies b ON b.id = p.right_id), pairs AS (SELECT DISTINCT hash(x, y) AS k, x, y FROM m), {_STEPS_SQL} SELECT pair_id, {_TOKENS_SQL.format('x')} AS t, CAST(ed AS INTEGER) AS d FROM m LEFT JOIN done ON done.k = hash(x, y)")
def sv_f38_whole_distance(spark: SparkSession, folder: str) -> DataFrame:
    """Sorted tokens and edit distance of matched names with all their letters."""
    c = table(spark, folder, "companies").select("id", _names("name").alias("n"))
    m = table(spark, folder, "match_pairs").select("pair_id", "left_id", "right_id")
    both = m.join(c.select(F.col("id").alias("left_id"), F.col("n").alias("x")), "left_id").join(c.select(F.col("id").alias("right_id"), F.col("n").alias("y")), "right_id")
    return both.select("pair_id", sorted_tokens(F.col("x")).alias("t"), F.levenshtein("x", "y").alias("d"))


@query(f"WITH RECURSIVE m AS (SELECT p.pair_id, {_TOKENS_SQL.format(_match_sql('a.name'))} AS x, {_TOKENS_SQL.format(_match_sql('b.name'))} AS y FROM match_pairs p JOIN companies a ON a.id = p.left_id JOIN companies b ON b.id = p.right_id), pairs AS (SELECT DISTINCT hash(x, y) AS k, x, y FROM m), {_STEPS_SQL} SELECT pair_id, round(CASE WHEN nx + ny = 0 THEN 0.0 ELSE 200.0 * lc / (nx + ny) END, 4) AS ratio FROM m LEFT JOIN done ON done.k = hash(x, y)")
def sv_f38_token_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Token-sort ratio of matched names, from the longest common subsequence of their sorted words."""
    return sv_f38_name_ratio(spark, folder).select("pair_id", "ratio")


@query()
def sv_f38_name_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Token-sort ratio and Ratcliff-Obershelp ratio of matched names."""
    c = table(spark, folder, "companies").select("id", tx.match_name("name").alias("n"))
    m = table(spark, folder, "match_pairs").select("pair_id", "left_id", "right_id")
    both = m.join(c.select(F.col("id").alias("left_id"), F.col("n").alias("x")), "left_id").join(c.select(F.col("id").alias("right_id"), F.col("n").alias("y")), "right_id")
    x, y = sorted_tokens(F.col("x")), sorted_tokens(F.col("y"))
    return both.select("pair_id", F.round(indel_ratio(x, y), 4).alias("ratio"), F.round(gestalt_ratio("x", "y"), 4).alias("gestalt"), may_reach(x, y, 88).cast("int").alias("may_reach"))


_RULE_SQL = "CASE WHEN canonical_domain LIKE '%/%' THEN 'R1' WHEN venture_scale_score < 0 OR venture_scale_score > 10 THEN 'R2' WHEN coalesce(summary, '') = '' THEN 'R3' END"


@query(f"SELECT id, CAST({_RULE_SQL} IS NOT NULL AS INTEGER) AS matched, {_RULE_SQL} AS rule_id FROM companies")
def sv_r01_first_match(spark: SparkSession, folder: str) -> DataFrame:
    """First-match rules as data (the R-style engine without its business rules)."""
    score = F.col("venture_scale_score")
    found = rules.first_match([rules.Rule("R1", F.col("canonical_domain").contains("/"), F.lit("path in domain")), rules.Rule("R2", (score < 0) | (score > 10), F.concat(F.lit("score "), score.cast("string"))), rules.Rule("R3", tx.absent("summary"), F.lit("no summary"))])
    return table(spark, folder, "companies").withColumn("r", found).select("id", F.col("r.matched").cast("int").alias("matched"), "r.rule_id")
