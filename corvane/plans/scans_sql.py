"""Survey queries of the scans (S), model calls (L) and streams, over pages and feeds made from whole tables.

The pages are written by expressions over the test tables, so what a scan must give back is known in SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.model_calls.map import call_model
from corvane.model_calls.provider import KeywordProvider
from corvane.plans.common import table
from corvane.scratch import scratch_dir
from corvane.sources import feeds, layouts
from corvane.sources.html import Layout, page_text, scan_pages
from corvane.streaming.ingest import windowed_counts

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _safe(c: str) -> Column:
    """Text that can stand in a page: without mark-up characters, white space collapsed."""
    return tx.squeeze(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[<>&\"']", ""))


def _safe_sql(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(coalesce(CAST({c} AS VARCHAR), ''), '[<>&\x22\x27]', '', 'g'), '[\s\p{{Z}}\x0B\x{{85}}]+', ' ', 'g'))"


def _pages(spark: SparkSession, folder: str, html: str) -> DataFrame:
    """One page a company from a template with {columns}."""
    import re

    parts = re.split(r"\{(\w+)\}", html)
    pieces = [F.lit(p) if i % 2 == 0 else _safe(p) for i, p in enumerate(parts) if p or i % 2]
    return table(spark, folder, "companies").select("id", F.concat(*pieces).alias("html"))


def _scan(spark: SparkSession, folder: str, html: str, layout: Layout) -> DataFrame:
    return scan_pages(_pages(spark, folder, html), layout, "id").drop("seq")


_N, _S, _X = _safe_sql("name"), _safe_sql("summary"), _safe_sql("sub_sector")


@query(f"SELECT id, nullif(regexp_replace({_N}, '[\\s\\-.]+$', ''), '') AS name, id AS slug FROM companies WHERE nullif(regexp_replace({_N}, '[\\s\\-.]+$', ''), '') IS NOT NULL")
def sv_s01_profile_cards(spark: SparkSession, folder: str) -> DataFrame:
    """Profile cards of a listing."""
    return _scan(spark, folder, "<html><body><article class='cc--component-container cc--profile-card'><h3><a href='/person/{id}'>{name} -</a></h3></article><article><h3>x</h3></article></body></html>", layouts.PROFILE_CARDS)


@query(f"SELECT id, {_N} AS name, 'https://' || id || '.example' AS website FROM companies WHERE length({_N}) >= 3")
def sv_s01_link_list(spark: SparkSession, folder: str) -> DataFrame:
    """Lists of links; footers, short names and repetitions are no entries."""
    return _scan(spark, folder, "<ul class='links-container'><li><a href='https://{id}.example'>{name}</a><li><a href='https://{id}.example'>{name}</a><li><a href='https://x.example'>ab</a></ul><div class='f--field f--wysiwyg'>Contact Us<ul><li><a href='https://f.example'>Footer</a></ul></div>", layouts.LINK_LIST)


@query(f"SELECT id, {_N} AS name, nullif({_S}, '') AS description, 'https://' || id || '.example' AS website, CAST(CASE WHEN {_S} <> '' THEN NOT contains(lower(substr({_S}, 1, 100)), lower(string_split({_N}, ' ')[1])) END AS INTEGER) AS mismatch FROM companies")
def sv_s01_profile(spark: SparkSession, folder: str) -> DataFrame:
    """One profile page, with the flag for a description that does not begin with the name."""
    pages = _pages(spark, folder, "<div class='header-container'><p class='f--field f--text'>{name}</p><p class='f--field f--text'>Presenting</p></div><a class='button--alt' href='https://{id}.example'>site</a><div class='f--field f--wysiwyg'><p>{summary}</p></div>")
    layout = Layout(layouts.PROFILE.rows, layouts.PROFILE.columns | {"name": lambda d: d.first(".f--field.f--text").text() or ""}, ())
    df = scan_pages(pages, layout, "id")
    word = F.lower(F.get(F.split("name", " "), F.lit(0)))
    return df.select("id", "name", "description", "website", (~F.lower(F.substring("description", 1, 100)).contains(word)).cast("int").alias("mismatch"))


@query(f"SELECT id, CASE WHEN length({_N}) < 1 THEN 'https://' || id || '.example' ELSE {_N} END AS name, 'https://' || id || '.example' AS website FROM companies WHERE regexp_matches(lower({_N}), 'energy|carbon|grid')")
def sv_s02_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Feed items with a title word, and the links in their articles."""
    feed = table(spark, folder, "companies").select("id", F.concat(F.lit("<rss><channel><item><title>"), _safe("name"), F.lit("</title><link>"), F.col("id"), F.lit("</link><description>&lt;p&gt;&lt;a href='https://"), F.col("id"), F.lit(".example'&gt;"), _safe("name"), F.lit("&lt;/a&gt;&lt;/p&gt;</description></item></channel></rss>")).alias("xml"))
    items = feeds.rss_items(feed).where(tx.has_any("title", ["energy", "carbon", "grid"]))
    return scan_pages(items.select(F.col("link").alias("id"), F.col("description").alias("html")), layouts.ARTICLE_LINKS, "id").select("id", "name", "website")


@query(f"SELECT id, {_N} AS name, 'https://' || id || '.example/' AS website, nullif({_S}, '') AS description, CASE WHEN {_X} = 'hydrogen' THEN 'current' ELSE 'alumni' END AS cohort FROM companies WHERE {_N} <> ''")
def sv_s03_participants(spark: SparkSession, folder: str) -> DataFrame:
    """Participant cards; the cohort is a class of the card."""
    pages = _pages(spark, folder, "<a class='grid-item participant {sub_sector}' href='https://{id}.example/'><div class='grid-item-title'>{name}</div><div class='grid-item-description'><p>{summary}</p></div></a>")
    pages = pages.withColumn("html", F.replace("html", F.lit("participant hydrogen'"), F.lit("participant warm-gradient'")))
    return scan_pages(pages, layouts.PARTICIPANTS, "id").select("id", "name", "website", "description", "cohort")


@query("SELECT id, id AS slug, CASE WHEN sub_sector IS NULL THEN 'I' ELSE 'II' END AS fund FROM companies")
def sv_s04_portfolio_index(spark: SparkSession, folder: str) -> DataFrame:
    """Slugs of an index with the fund named by the heading above them."""
    fund = F.when(F.col("sub_sector").isNull(), F.lit("Fund I")).otherwise(F.lit("Fund II"))
    pages = table(spark, folder, "companies").select("id", F.concat(F.lit("<section><h2>Fund I</h2><div></div></section><section><h2>"), fund, F.lit("</h2><div><div class='w-dyn-items'><a class='portfolios-hero-link' href='/portfolio/"), F.col("id"), F.lit("?x'>x</a></div></div></section>")).alias("html"))
    return scan_pages(pages, layouts.PORTFOLIO_INDEX, "id").drop("seq")


@query(f"SELECT id, {_N} AS name, nullif({_X}, '') AS location FROM companies WHERE {_N} <> ''")
def sv_s04_portfolio_detail(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled cards of a detail page."""
    return _scan(spark, folder, "<h2 class='heading-b-36px'>{name}</h2><p class='paragraph-16px'>d</p><div class='desc-card-wrap'><div class='text-18px-bold w-condition-invisible'>No</div><div class='text-18px-bold'>Headquarters</div><div class='paragraph-16px projects'>{sub_sector}</div></div>", layouts.PORTFOLIO_DETAIL).select("id", "name", "location")


@query("SELECT id, 'https://www.' || id || '.example' AS website, 'https://cdn.example/' || id || '-logo.png' AS image FROM companies")
def sv_s05_logo_cards(spark: SparkSession, folder: str) -> DataFrame:
    """Cards whose name is in an image; names by F14 and F15."""
    return _scan(spark, folder, "<div class='companies__item w-dyn-item'><a class='companies__card' href='https://www.{id}.example'><img class='companies__logo' src='https://cdn.example/{id}-logo.png'></a></div>", layouts.LOGO_CARDS).select("id", "website", "image")


@query(f"SELECT id, {_N} AS name, id AS slug FROM companies WHERE {_N} <> '' AND sub_sector IS NOT NULL")
def sv_s06_members(spark: SparkSession, folder: str) -> DataFrame:
    """Members of a page of a paged listing; a page that says it has none ends it."""
    pages = _pages(spark, folder, "<a class='col-4 card' href='https://x.example/members/{id}/'><h2 class='entry-title'>{name}</h2></a>")
    empty = table(spark, folder, "companies").select("id", F.when(F.col("sub_sector").isNull(), F.lit("<p class='no-results'>none</p>")).otherwise("").alias("tail"))
    return scan_pages(pages.join(empty, "id").withColumn("html", F.concat("html", "tail")), layouts.MEMBERS, "id").select("id", "name", "slug")


@query(f"SELECT id, trim({_N} || ', ' || {_X}) AS item FROM companies")
def sv_s07_article_items(spark: SparkSession, folder: str) -> DataFrame:
    """List items of the first article of a page."""
    return _scan(spark, folder, "<article><ul><li>{name}, {sub_sector}</li></ul></article><article><ul><li>other</li></ul></article>", layouts.ARTICLE_ITEMS)


@query(f"SELECT id, {_N} AS name, '/tenants/' || id AS detail_url, id AS slug FROM companies WHERE {_N} <> ''")
def sv_s08_tenants(spark: SparkSession, folder: str) -> DataFrame:
    """Tenants of the offices section only."""
    return _scan(spark, folder, "<div class='section-map-places'><div><h3>Food</h3><ul><li class='tenant'><a href='/tenants/f'>f</a></li></ul></div><div><h3>Offices</h3><ul><li class='tenant'><a href='/tenants/{id}'><span>{name}</span><sup>2</sup></a></li></ul></div></div>", layouts.TENANTS).select("id", "name", "detail_url", "slug")


@query(f"SELECT id, {_N} AS name, 'U' AS university, 'https://' || id || '.example' AS website FROM companies WHERE {_N} <> ''")
def sv_s09_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a table."""
    return _scan(spark, folder, "<table><thead><tr><th>n</th></tr></thead><tbody><tr><td>{name}</td><td>U</td><td><a href='https://{id}.example'>w</a></td></tr><tr><td></td></tr></tbody></table>", layouts.STARTUP_TABLE)


@query(f"SELECT id, nullif({_N}, '') AS name, nullif({_S}, '') AS description, id AS slug FROM companies")
def sv_s10_slug_cards(spark: SparkSession, folder: str) -> DataFrame:
    """Cards with a slug."""
    return _scan(spark, folder, "<a class='company-card' href='https://x.example/c/{id}/'><h4 class='title-lg-company'>{summary}</h4><h5 class='text-base'>{name}</h5></a>", layouts.SLUG_CARDS).drop("source_url")


@query(f"SELECT id, {_N} AS name, nullif('all,' || {_X}, '') AS sectors, id AS slug FROM companies WHERE {_N} <> ''")
def sv_s11_data_cards(spark: SparkSession, folder: str) -> DataFrame:
    """Cards with data attributes."""
    return _scan(spark, folder, "<article class='company-card' data-sector='all,{sub_sector}'><a class='company-card__figure-link' aria-label='{name}' href='https://x.example/companies/{id}'></a></article>", layouts.DATA_CARDS).select("id", "name", "sectors", "slug")


@query("SELECT id, 0 AS seq, id AS codename FROM companies UNION ALL SELECT id, 1, 'b' FROM companies")
def sv_s12_embedded(spark: SparkSession, folder: str) -> DataFrame:
    """Objects of a kind anywhere in a page's embedded state."""
    pages = _pages(spark, folder, '<script>window.__STATE__ = {"a": [{"system": {"type": "company", "codename": "{id}"}, "in": {"system": {"type": "company"}}}], "b": {"c": {"system": {"type": "company", "codename": "b"}}}};</script>')
    found = feeds.embedded_objects(pages, "id", "html", "window.__STATE__", "company")
    return found.select("id", "seq", F.get_json_object("object", "$.system.codename").alias("codename"))


@query("SELECT 'F-' || id AS adsh, nullif(trim(name), '') AS display_name, CAST(NULL AS VARCHAR) AS location FROM companies")
def sv_s13_filings(spark: SparkSession, folder: str) -> DataFrame:
    """Hits of a search response."""
    hit = F.to_json(F.struct(F.struct(F.array(F.struct(F.struct(F.array(F.trim("name")).alias("display_names"), F.concat(F.lit("F-"), "id").alias("adsh")).alias("_source"))).alias("hits")).alias("hits")))
    df = feeds.filings(table(spark, folder, "companies").select(hit.alias("j")), "j")
    return df.select("adsh", tx.blank_to_null("display_name").alias("display_name"), "location")


@query(f"SELECT {_N} AS name, CASE WHEN {_X} = '' THEN 'Unlisted' ELSE {_X} END AS company, 'Fellow' AS role FROM companies WHERE {_N} <> '' AND lower({_N}) <> 'roster'")
def sv_s18_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks between blank lines of a roster."""
    text = F.concat(F.lit("Roster\n2026\n\n"), _safe("name"), F.lit("\n"), F.when(_safe("sub_sector") == "", F.lit("Unlisted")).otherwise(_safe("sub_sector")), F.lit("\n\nalone\n"))
    return feeds.text_blocks(table(spark, folder, "companies").select(text.alias("t")), "t", ["Roster"], "Fellow").drop("seq")


@query(f"SELECT id, trim({_N} || ' ' || {_X}) AS text FROM companies")
def sv_f27_page_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text of a page without scripts and navigation."""
    df = page_text(_pages(spark, folder, "<html><head><title>t</title></head><nav>n</nav><p>{name}</p><script>s()</script><p>{sub_sector}</p></html>"), "id")
    return df


@query("SELECT id, CASE WHEN length(trim(coalesce(trim(summary), ''))) < 20 THEN 'short' ELSE 'ok' END AS status FROM companies")
def sv_l01_model_calls(spark: SparkSession, folder: str) -> DataFrame:
    """A model over all summaries, with the offline provider; short texts are not sent."""
    provider = KeywordProvider({"hydrogen": ["hydrogen"], "geothermal": ["geothermal", "thermal"]})
    log = call_model(table(spark, folder, "companies"), "id", ["summary"], "Classify.\n---USER---\n{{summary}}", provider, least_text=20)
    return log.select("id", "status")


@query("SELECT strftime(time_bucket(INTERVAL 10 MINUTES, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def sv_x_stream_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events in ten-minute windows as a stream that ends with what is there."""
    place = f"{scratch_dir(spark)}/counts-{uuid.uuid4().hex}"
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = windowed_counts(stream, "ts", "1 hour", "10 minutes", None, ["event_type"])
    counts = counts.select("window_start", "event_type", "n")
    write = lambda batch, _: batch.write.mode("overwrite").parquet(place)  # noqa: E731  the whole result so far; a batch that is run again writes the same
    counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{place}-state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(place).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")
