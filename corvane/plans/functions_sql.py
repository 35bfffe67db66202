"""Survey queries of the scalar functions (F) and predicates (P), over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators.snapshot_diff import as_set
from corvane.plans.common import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _project(key: str, source: str, row: str, columns: Callable[[], dict[str, Column]], sql: dict[str, str], make=None, ctes: str = "", where: str | None = None) -> None:
    """Register a projection: ``columns`` in Spark, ``sql`` in DuckDB, under the same names."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        df = table(spark, folder, source)
        df = df.where(where) if where else df
        return df.select(row, *[c.alias(n) for n, c in (make or columns)().items()])

    QUERIES[key] = query
    body = ", ".join([row, *[f"{e} AS {n}" for n, e in sql.items()]])
    SQL[key] = f"{ctes} SELECT {body} FROM {source}" + (f" WHERE {where}" if where else "")


def _title(e: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({e}), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ')"


_MATCH = r"'\b(inc|llc|lp|ltd|corp|co\.?|plc|gmbh|bv|pbc|llp|holdings|group|international)\b[\.,]?\s*$'"
_ENDS = "inc|llc|ltd|corp|corporation|co|company|holdings|group|ventures|technologies|technology|tech|solutions|labs|laboratory|laboratories|energy|capital|partners|associates|services|systems|international"


def _end_sql(x: str) -> str:
    blank = "' ' || chr(9) || chr(10) || chr(13)"
    return rf"trim(trim(trim(regexp_replace({x}, '\b({_ENDS})\b\.?\s*$', '', 'i'), {blank}), ','), {blank})"


def _match_sql(x: str) -> str:
    s = rf"trim(regexp_replace(trim({x}), '\s*\([^)]*\)', '', 'g'))"
    for _ in range(3):
        s = rf"trim(regexp_replace(trim(regexp_replace({s}, {_MATCH}, '', 'i')), ',+$', ''))"
    return f"lower({s})"


def _domain_sql(x: str) -> str:
    s = rf"regexp_extract(regexp_replace(regexp_replace(rtrim(lower(trim({x})), '/'), '^https?://', ''), '^www\.', ''), '^([^/?#]*)', 1)"
    return f"CASE WHEN contains({s}, '.') AND {s} NOT IN ('example.com', 'localhost') THEN {s} END"


def _slug_sql(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-')"


def _squeeze_sql(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[\s\p{{Z}}\x0B\x{{85}}]+', ' ', 'g'))"


_project("sv_f01_match_name", "companies", "id", lambda: {"v": tx.match_name("name")}, {"v": _match_sql("name")})
_project("sv_f02_bare_domain", "companies", "id", lambda: {"v": tx.bare_domain("website"), "w": tx.bare_domain("canonical_domain")}, {"v": _domain_sql("website"), "w": _domain_sql("canonical_domain")})
_URL = "CASE WHEN regexp_matches(rtrim(trim(website), '/'), '(?i)^https?://') THEN rtrim(trim(website), '/') ELSE 'https://' || rtrim(trim(website), '/') END"
_project("sv_f03_full_url", "raw_records", "id", lambda: {"v": tx.full_url("website")}, {"v": f"CASE WHEN contains(regexp_extract({_URL}, '^[a-zA-Z]+://([^/?#]*)', 1), '.') THEN {_URL} END"})
_project("sv_f04_base_url", "raw_records", "id", lambda: {"v": tx.base_url("website")}, {"v": _URL.replace("(?i)", "")})
_project("sv_f05_url_host", "raw_records", "id", lambda: {"v": F.regexp_extract("source_url", r"^[a-z]+://([^/?#]*)", 1)}, {"v": "regexp_extract(source_url, '^[a-z]+://([^/?#]*)', 1)"})
_project(
    "sv_f06_slugs", "companies", "id", lambda: {"by_name": tx.name_slug("name"), "by_domain": tx.domain_slug("canonical_domain")},
    {"by_name": _slug_sql(f"strip_accents(lower({_end_sql('name')}))"), "by_domain": _slug_sql(_domain_sql("canonical_domain"))},
)
_project("sv_f07_display_key", "companies", "id", lambda: {"v": tx.display_key("name")}, {"v": f"lower({_end_sql(_squeeze_sql('name'))})"})
_project("sv_f08_slug", "raw_records", "id", lambda: {"v": tx.slug("name_raw")}, {"v": _slug_sql("name_raw")})
_project("sv_f09_job_slug", "companies", "id", lambda: {"v": tx.job_slug("name")}, {"v": _slug_sql("regexp_replace(trim(name), '[,.]+$', '')")})
_TOKENS, _TOKENS_SQL = lambda: F.concat(F.lit("all,"), F.replace(F.col("sub_sector"), F.lit("_"), F.lit("-")), F.lit(",water-reuse")), "('all,' || replace(sub_sector, '_', '-') || ',water-reuse')"
_project("sv_f10_drop_all", "companies", "id", lambda: {"v": tx.drop_all_token(_TOKENS())}, {"v": f"trim(regexp_replace(trim({_TOKENS_SQL}), '^all,?', ''))"})
_project(
    "sv_f11_sector_tags", "companies", "id", lambda: {"v": F.array_join(tx.sector_tags(_TOKENS()), "|")},
    {"v": f"array_to_string(list_transform(list_filter(list_transform(string_split(regexp_replace({_TOKENS_SQL}, '^all,?', ''), ','), lambda t: trim(t)), lambda t: t <> ''), lambda t: {_title("replace(t, '-', ' ')")}), '|')"},
)
_SHOWN = lambda: F.concat("name", F.when(F.col("sub_sector").isNotNull(), F.concat(F.lit(" – "), "sub_sector")).otherwise(""), F.when(F.col("website").isNull(), F.lit(" (Coming Soon)")).otherwise(""))
_SHOWN_SQL = "(name || CASE WHEN sub_sector IS NOT NULL THEN ' – ' || sub_sector ELSE '' END || CASE WHEN website IS NULL THEN ' (Coming Soon)' ELSE '' END)"
_BARE_SQL = rf"trim(regexp_replace({_SHOWN_SQL}, '\s*\(coming soon\)\s*', '', 'gi'))"
_CUT = r"'\s*[–—]\s*|\s+-\s+'"
_project(
    "sv_f12_display_name", "companies", "id", lambda: {}, 
    {
        "clean": f"trim(CASE WHEN regexp_matches({_BARE_SQL}, {_CUT}) THEN regexp_extract({_BARE_SQL}, '^(.*?)(?:' || {_CUT} || ')(.*)$', 1) ELSE {_BARE_SQL} END)",
        "programme": f"nullif(trim(CASE WHEN regexp_matches({_BARE_SQL}, {_CUT}) THEN regexp_extract({_BARE_SQL}, '^(.*?)(?:' || {_CUT} || ')(.*)$', 2) END), '')",
        "soon": f"CAST(regexp_matches({_SHOWN_SQL}, '(?i)\\(coming soon\\)') AS INTEGER)",
    },
    make=lambda: dict(zip(("clean", "programme", "soon"), (lambda p: (p[0], p[1], p[2].cast("int")))(tx.split_program(_SHOWN())))),
)
_project("sv_f13_split_once", "companies", "id", lambda: {"head": F.get(F.split("name", r"\s+-\s+", 2), F.lit(0))}, {"head": r"regexp_replace(name, '\s+-\s+.*$', '')"})
_IMAGE = lambda: F.concat(F.lit("https://cdn.example/a/0123456789abcdef01234567_"), "id", F.lit("-logo-dark.png?x=1"))
_IMAGE_SQL = r"regexp_replace(regexp_replace(regexp_replace(id || '-logo-dark.png', '\.(png|jpg|jpeg|webp|svg|gif)$', '', 'i'), '[-_]?(logo|icon|img|image|thumbnail|photo|full|white|dark|color|bw|black|new|v[0-9]+).*$', '', 'i'), '^[0-9a-f]{24}_', '', 'i')"
_project("sv_f14_image_name", "companies", "id", lambda: {"v": tx.name_from_image(_IMAGE())}, {"v": f"nullif({_title(f"trim(translate({_IMAGE_SQL}, '-_', '  '))")}, '')"})
_HOST_SQL = r"regexp_replace(regexp_replace(regexp_extract(website, '^[a-z]+://([^/?#:]*)', 1), '^www\.', ''), '\.[a-z]{2,}$', '')"
_project("sv_f15_domain_name", "companies", "id", lambda: {"v": tx.name_from_domain("website")}, {"v": f"nullif({_title(f"trim(translate({_HOST_SQL}, '-_', '  '))")}, '')"})
_ITEM = lambda: F.concat(F.lit("Houston-based "), "name", F.lit(", which "), F.coalesce("sub_sector", F.lit("")))
_ITEM_SQL = "trim('Houston-based ' || name || ', which ' || coalesce(sub_sector, ''))"
_PLACE_SQL = rf"regexp_extract({_ITEM_SQL}, '^(?:[A-Z][^,]+,\s+)?[A-Z][a-z][\w\s]*[-–]based\s+', 0)"
_REST_SQL = rf"trim(regexp_replace(substr({_ITEM_SQL}, length({_PLACE_SQL}) + 1), ',?\s+housed at [^,.]+', '', 'gi'))"
_GOOD_SQL = f"length({_ITEM_SQL}) >= 5 AND NOT ends_with({_ITEM_SQL}, '›') AND NOT ends_with({_ITEM_SQL}, '>')"


def sv_f16_all_items(spark: SparkSession, folder: str) -> DataFrame:
    """``list_item`` over all companies, names with commas, places, clauses or NULL included."""
    item, about, place = tx.list_item(_ITEM())
    return table(spark, folder, "companies").select("id", item.alias("item"), about.alias("about"), place.alias("place"))


QUERIES["sv_f16_all_items"] = sv_f16_all_items
SQL["sv_f16_all_items"] = rf"""SELECT id, CASE WHEN {_GOOD_SQL} THEN nullif(trim(string_split({_REST_SQL}, ',')[1]), '') END AS item,
    CASE WHEN {_GOOD_SQL} AND contains({_REST_SQL}, ',') THEN nullif(regexp_replace(trim(substr({_REST_SQL}, instr({_REST_SQL}, ',') + 1)), '^(which |that |is )+', ''), '') END AS about,
    CASE WHEN {_GOOD_SQL} THEN nullif(regexp_replace(trim({_PLACE_SQL}), '[-–]based$', ''), '') END AS place FROM companies"""
_project("sv_f17_prefix_key", "companies", "id", lambda: {"v": tx.prefix_key("name")}, {"v": r"trim(regexp_replace(trim(regexp_replace(lower(name), '[\s,.\-&]+', ' ', 'g')), '\s+(inc|llc|ltd|corp|co)\.?$', ''))"})
_project("sv_f18_artefacts", "companies", "id", lambda: {"v": tx.trim_artefacts("name")}, {"v": r"trim(regexp_replace(trim(name), '[\s\-.]+$', ''))"})
_project("sv_f19_keys", "companies", "id", lambda: {"v": F.lower(tx.squeeze("name")), "w": tx.plain_key("name")}, {"v": f"lower({_squeeze_sql('name')})", "w": r"trim(regexp_replace(regexp_replace(lower(name), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g'))"})
_project("sv_f20_year", "companies", "id", lambda: {"v": tx.year_in("first_seen_at")}, {"v": r"CAST(nullif(regexp_extract(first_seen_at, '\b(20[0-9]{2})\b', 1), '') AS INTEGER)"})
_project("sv_f21_path_slug", "raw_records", "id", lambda: {"v": tx.path_slug("source_url", "c")}, {"v": "nullif(regexp_extract(source_url, '/c/([^/?#]+)', 1), '')"})
_project("sv_f22_entity_name", "companies", "id", lambda: {"v": tx.entity_name("name")}, {"v": f"nullif({_squeeze_sql(r"regexp_replace(name, '(\s*\([^)]*\))+\s*$', '')")}, '')"})
_project(
    "sv_f23_filing_url", "orders", "o_orderkey", lambda: {"v": tx.filing_url(F.lpad(F.col("o_custkey").cast("string"), 10, "0"), F.concat_ws("-", "o_orderkey", F.lit("26"), "o_custkey"), "https://filings.example/")},
    {"v": "CASE WHEN o_custkey <> 0 THEN 'https://filings.example/' || ltrim(lpad(CAST(o_custkey AS VARCHAR), 10, '0'), '0') || '/' || CAST(o_orderkey AS VARCHAR) || '26' || CAST(o_custkey AS VARCHAR) || '/' END"},
)
_CODES = {"hydrogen": "H", "geothermal": "G", "off_thesis": "X"}
_project("sv_f24_code_tags", "raw_records", "id", lambda: {"v": F.array_join(tx.code_tags(as_set(F.col("tags")), _CODES), ",")}, {
    "v": "array_to_string(list_filter(list_transform(list_sort(list_distinct(coalesce(CAST(try_cast(tags AS JSON) AS VARCHAR[]), []))), lambda t: CASE trim(t) WHEN 'hydrogen' THEN 'H' WHEN 'geothermal' THEN 'G' WHEN 'off_thesis' THEN 'X' END), lambda t: t IS NOT NULL), ',')"})
_project("sv_f25_labelled", "companies", "id", lambda: {"v": tx.labelled("sub_sector", {"HYDROGEN": "Hydrogen"})}, {"v": "CASE WHEN upper(trim(sub_sector)) = 'HYDROGEN' THEN 'Hydrogen' ELSE coalesce(nullif(upper(trim(sub_sector)), ''), 'Unknown') END"})
_project("sv_f26_template", "companies", "id", lambda: {"v": F.concat("name", F.lit(" — "), F.coalesce("sub_sector", F.lit("?")), F.when(F.col("venture_scale_score").between(0, 10), F.format_string(", %.1f", F.round("venture_scale_score", 1))).otherwise(""))}, {
    "v": "name || ' — ' || coalesce(sub_sector, '?') || CASE WHEN venture_scale_score BETWEEN 0 AND 10 THEN format(', {:.1f}', round(venture_scale_score, 1)) ELSE '' END"})
_PAGE = lambda: F.concat(F.lit("<p class='a'>"), F.replace(F.replace("text", F.lit("<"), F.lit(" ")), F.lit(">"), F.lit(" ")), F.lit("</p><script>x</script>&amp;"))
_project("sv_f27_strip_tags", "documents", "doc_id", lambda: {"v": F.md5(tx.strip_tags(_PAGE()))}, {
    "v": f"md5({_squeeze_sql("replace(replace(replace(replace(replace(replace(' ' || replace(replace(text, '<', ' '), '>', ' ') || '  &amp;', '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')")})"})
_project("sv_f28_shorten", "raw_records", "id", lambda: {"v": tx.shorten("description", 60)}, {"v": "CASE WHEN length(description) > 60 THEN regexp_replace(substr(description, 1, 60), ' [^ ]*$', '') || '…' ELSE description END"})
_ZIP, _ZIP_SQL = lambda: F.concat(F.lit("Suite 9, Houston TX "), F.lpad((F.col("id") % 100000).cast("string"), 5, "0")), "('Suite 9, Houston TX ' || lpad(CAST(id % 100000 AS VARCHAR), 5, '0'))"
_project("sv_f29_zip", "raw_records", "id", lambda: {"v": tx.zip_in(_ZIP())}, {"v": rf"nullif(regexp_extract({_ZIP_SQL}, '\b([0-9]{{5}})\b', 1), '')"})
_BOTH = lambda: tx.json_or_text("source_ids", "array<string>")
_project("sv_f30_json", "companies", "id", lambda: {"v": F.array_join(_BOTH()["value"], "; "), "t": _BOTH()["text"]}, {
    "v": "array_to_string(CAST(try_cast(nullif(source_ids, '') AS JSON) AS VARCHAR[]), '; ')", "t": "CASE WHEN NOT json_valid(nullif(source_ids, '')) THEN source_ids END"})
_project("sv_f31_location", "raw_records", "id", lambda: {"v": F.coalesce(F.get_json_object("extra", "$.contact"), "location_raw")}, {"v": "coalesce(json_extract_string(extra, '$.contact'), location_raw)"})
_project("sv_f32_window", "orders", "o_orderkey", lambda: {"v": F.date_format(tx.days_before("o_orderdate", 395), "yyyy-MM-dd")}, {"v": "strftime(CAST(o_orderdate AS DATE) - 395, '%Y-%m-%d')"})
_project("sv_f34_number", "raw_records", "id", lambda: {"v": tx.number_or_null(F.get_json_object("extra", "$.page"))}, {"v": "try_cast(json_extract_string(extra, '$.page') AS DOUBLE)"})
_project("sv_f36_cut", "documents", "doc_id", lambda: {"v": F.md5(F.substring("text", 1, 800))}, {"v": "md5(substr(text, 1, 800))"})
_project("sv_f40_cost", "documents", "doc_id", lambda: {"v": F.round(tx.token_cost(tx.estimated_tokens("text"), F.lit(133), 3.0, 15.0), 9), "n": tx.estimated_tokens("text")}, {"v": "round((floor(length(text) / 4) * 3.0 + 133 * 15.0) / 1000000, 9)", "n": "CAST(floor(length(text) / 4) AS BIGINT)"})
#: Prices for a million tokens in and out of three tiers of models.
PRICES = {"standard": (3.0, 15.0), "large": (15.0, 75.0), "small": (0.25, 1.25)}
_TIER = lambda: F.when(F.col("lang") == "en", "small").when(F.col("lang") == "de", "large").when(F.col("lang") == "fr", "standard").otherwise(F.col("lang"))
_project("sv_f40_models", "documents", "doc_id", lambda: {"v": F.round(tx.model_cost(_TIER(), tx.estimated_tokens("text"), F.lit(133), PRICES, "standard"), 9)}, {
    "v": "round(CASE lang WHEN 'en' THEN floor(length(text) / 4) * 0.25 + 133 * 1.25 WHEN 'de' THEN floor(length(text) / 4) * 15.0 + 133 * 75.0 ELSE floor(length(text) / 4) * 3.0 + 133 * 15.0 END / 1000000, 9)"})
_project("sv_f37_status", "companies", "id", lambda: {"status": tx.enrichment_status("sub_sector", "venture_scale_score", "venture_scale_confidence", "summary")}, {
    "status": "CASE WHEN sub_sector = 'off_thesis' THEN 'off_thesis' WHEN venture_scale_score = 5.0 AND upper(coalesce(venture_scale_confidence, '')) = 'LOW' AND trim(coalesce(summary, '')) = '' THEN 'pending_description' ELSE 'enriched' END"})
_project("sv_f42_fence", "companies", "id", lambda: {"v": F.get_json_object(tx.fence_json(F.concat(F.lit("```json\n{\"s\": \""), F.coalesce("sub_sector", F.lit("")), F.lit("\"}\n```"))), "$.s")}, {"v": "coalesce(sub_sector, '')"})
_WORDS = ["energy", "grid", "carbon", "wind"]
_project("sv_p01_title_words", "raw_records", "id", lambda: {"v": tx.has_any("name_raw", _WORDS).cast("int")}, {"v": "CAST(coalesce(regexp_matches(lower(name_raw), 'energy|grid|carbon|wind'), false) AS INTEGER)"})
_project("sv_p01_text_words", "documents", "doc_id", lambda: {"v": tx.has_any("text", _WORDS).cast("int")}, {"v": "CAST(coalesce(regexp_matches(lower(text), 'energy|grid|carbon|wind'), false) AS INTEGER)"})
_project("sv_p03_outside_host", "raw_records", "id", lambda: {"v": tx.outside_host("website", ["pagehub.example", "linkrow.test"]).cast("int")}, {
    "v": r"CAST(coalesce(regexp_matches(website, '^https?://') AND h <> '' AND h NOT IN ('pagehub.example', 'linkrow.test') AND NOT ends_with(h, '.pagehub.example') AND NOT ends_with(h, '.linkrow.test'), false) AS INTEGER)"})
SQL["sv_p03_outside_host"] = SQL["sv_p03_outside_host"].replace("FROM raw_records", r"FROM (SELECT *, regexp_replace(lower(regexp_extract(website, '^https?://([^/?#:]*)', 1)), '^www\.', '') AS h FROM raw_records)")
_project("sv_p05_keywords", "companies", "id", lambda: {"v": tx.has_any("name", ["law", "legal", "llp"]).cast("int")}, {"v": "CAST(coalesce(regexp_matches(lower(name), 'law|legal|llp'), false) AS INTEGER)"})
_project("sv_p14_enough_text", "companies", "id", lambda: {"v": (F.length(F.trim(F.concat_ws(" ", "name", "summary"))) >= 40).cast("int")}, {"v": "CAST(length(trim(concat_ws(' ', name, summary))) >= 40 AS INTEGER)"})
_project("sv_p15_places", "raw_records", "id", lambda: {"v": tx.has_any("location_raw", ["houston", "katy"]).cast("int"), "r": F.coalesce(F.lower("location_raw").contains("remote"), F.lit(False)).cast("int")}, {
    "v": "CAST(coalesce(regexp_matches(lower(location_raw), 'houston|katy'), false) AS INTEGER)", "r": "CAST(coalesce(contains(lower(location_raw), 'remote'), false) AS INTEGER)"})
_project("sv_p16_zip_prefix", "raw_records", "id", lambda: {"v": tx.zip_prefix_in(tx.zip_in(_ZIP()), ["001", "017", "770"]).cast("int")}, {"v": f"CAST(lpad(CAST(id % 100000 AS VARCHAR), 5, '0')[1:3] IN ('001', '017', '770') AS INTEGER)"})
