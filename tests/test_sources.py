"""Readers: pages, feeds, worksheets, services."""

import io
import os
import sqlite3
import subprocess
import sys
import zipfile
from pathlib import Path

import pyspark
import pytest
from oracle import connect
from pyspark.sql import functions as F
from pyspark.sql.datasource import GreaterThan, In, IsNull, Not

from corvane.sources import feeds, layouts
from corvane.sources.database import SqliteTable, read_sqlite, read_table, write_sqlite, write_table
from corvane.sources.html import parse, scan_pages
from corvane.sources.paged import LandedPages, RateLimiter, candidate_pages, first_platform, lookup_first, read_until_short


def test_selectors():
    d = parse("<div id=a class='x y'><p>1<p>2<span data-k='v w'>3</span></div><ul><li>a<li>b</ul>")
    assert [n.text() for n in d.select("div.x p")] == ["1", "23"]
    assert d.first("#a span[data-k^='v']").text() == "3" and d.first("p.z") is None
    assert [n.text() for n in d.select("ul li")] == ["a", "b"]


def test_scan_handles_null_and_broken(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<a class='company-card' href='/c/s'><h5 class='text-base'>N"), (4, "<<>>&")], "page_id int, html string")
    out = scan_pages(pages, layouts.SLUG_CARDS).collect()
    assert [(r.page_id, r.name, r.slug) for r in out] == [(3, "N", "s")]


def test_rss(spark):
    xml = "<rss><channel><item><title>T</title><category>c1</category><category/></item></channel></rss>"
    out = feeds.rss_items(spark.createDataFrame([(xml,), ("no xml",), (None,)], "xml string")).collect()
    assert [(r.title, r.categories) for r in out] == [("T", ["c1"])]


def workbook():
    buffer = io.BytesIO()
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Large" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>24INR0001</t></si><si><t>Acme</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData><row><c r="A1" t="inlineStr"><is><t>INR</t></is></c></row><row><c r="A2" t="s"><v>0</v></c><c r="C2" t="inlineStr"><is><t>ia signed</t></is></c><c r="D2" t="s"><v>1</v></c><c r="E2" t="inlineStr"><is><t> houston</t></is></c></row></sheetData></worksheet>')
    return buffer.getvalue()


def test_worksheets(spark):
    files = spark.createDataFrame([("a.xlsx", bytearray(workbook())), ("b.xlsx", bytearray(b"no"))], "path string, content binary")
    rows = feeds.scan_worksheets(files, ["Large", "Small"], ["number", "project", "phase", "entity", "zone"])
    kept = feeds.queue_rows(rows, "HOUSTON", "Large").collect()
    assert [(r.number, r.entity) for r in kept] == [("24INR0001", "Acme")]


def test_json_lines(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    (tmp_path / "a.jsonl").write_text('{"id": "a", "n": 1}\n\nbroken\n{"id": "b", "n": 0}\n')
    schema = StructType([StructField("id", StringType()), StructField("n", IntegerType())])
    assert [r.id for r in feeds.read_json_lines(spark, str(tmp_path / "a.jsonl"), schema, "n >= 1").collect()] == ["a"]


def test_source_list():
    assert feeds.source_list("sources:\n  - name: 'A'  # x\n    url: u\n  # c\n  - name: B\n") == [{"name": "A", "url": "u"}, {"name": "B"}]


def test_embedded_and_missing():
    assert feeds.find_objects(feeds.embedded_state("x M = {\"system\": {\"type\": \"t\"}};", "M"), "t") and feeds.embedded_state(None, "M") is None and feeds.embedded_state("M {broken", "M") is None


def test_rate_limiter_and_paging():
    now, slept = [0.0], []
    r = RateLimiter(1.5, lambda: now[0], slept.append)
    r.wait()
    now[0] = 1.0
    r.wait()
    assert slept == [0.5]
    assert list(read_until_short(lambda o, n: list(range(o, min(o + n, 5))), 2, 1000)) == [0, 1, 2, 3, 4]


def test_landed_pages(spark, tmp_path):
    (tmp_path / "p.html").write_text("hello")
    spark.dataSource.register(LandedPages)
    out = spark.read.format("landed_pages").option("urls", f"{tmp_path}/p.html\n{tmp_path}/none").load().collect()
    assert sorted((r.body, r.error) for r in out if r.body) == [("hello", None)] and sum(r.error is not None for r in out) == 1


def test_lookups(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    got = spark.createDataFrame([("a", '{"success": true, "data": [{"name": "A1"}, {"name": "A2"}]}'), ("b", "broken")], "k string, body string")
    out = {r.k: (r.n_hits, r.first_hit and r.first_hit["name"]) for r in lookup_first(keys, got, "k", "struct<name:string>").collect()}
    assert out == {"a": (2, "A1"), "b": (0, None), "c": (0, None)}
    first = first_platform([spark.createDataFrame([("x", 1)], "k string, n int"), spark.createDataFrame([("x", 2), ("y", 3)], "k string, n int")], "k")
    assert sorted((r.k, r.n) for r in first.collect()) == [("x", 1), ("y", 3)]
    pages = spark.createDataFrame([("s/team", 200, "t" * 600), ("s/about", 200, "t" * 600), ("s/", 404, "t" * 600)], "url string, status int, text string")
    assert [r.url for r in candidate_pages(spark.createDataFrame([("s",)], "site string"), pages, "site", ["/", "/about", "/team"]).collect()] == ["s/about"]


def test_filings_null_safe(spark):
    assert feeds.filings(spark.createDataFrame([("{}",), ("x",), (None,)], "j string"), "j").count() == 0


@pytest.mark.parametrize("layout", [layouts.TENANTS, layouts.MEMBERS, layouts.WINNERS, layouts.STARTUP_TABLE, layouts.ARTICLE_LINKS])
def test_layouts_on_unrelated_pages(spark, layout):
    assert scan_pages(spark.createDataFrame([(1, "<p>nothing</p>")], "page_id int, html string"), layout).count() == 0


def test_winner_cards(spark):
    html = "<div class='c--mosaic-card'><div class='text-container'><h4>2013 finals</h4><p><strong>Acme</strong> - made it</p><p>First</p></div></div>"
    r = scan_pages(spark.createDataFrame([(1, html)], "page_id int, html string"), layouts.WINNERS).select("name", "placement", F.col("year")).first()
    assert tuple(r) == ("Acme", "First", "2013 finals")


ON_A_CLUSTER = """
from pyspark.sql import SparkSession
import __spark_entry__
conf = {"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "600m", "spark.checkpoint.dir": "FOLDER/shared", "spark.driver.host": "127.0.0.1", "spark.ui.enabled": "false"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
try:
    print("ROWS", sorted(tuple(r) for r in __spark_entry__.queries()["sv_s21_database"](spark, "DATA").collect()))
finally:
    spark.stop()
"""


def test_database_on_a_cluster(data, tmp_path):
    """Executors are processes of their own: what is in the memory of one is not in that of another."""
    import __spark_entry__

    home = tmp_path / "home"  # where the executors write their logs
    home.mkdir()
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_"))} | {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYTHONPATH": root, "PYSPARK_PYTHON": sys.executable}
    script = ON_A_CLUSTER.replace("FOLDER", str(tmp_path)).replace("DATA", data)
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    want = sorted(connect(data).execute(__spark_entry__.oracle_sql()["sv_s21_database"]).fetchall())
    assert out.stdout.rpartition("ROWS ")[2].strip() == str(want), out.stderr[-3000:]


def test_database_server(spark):
    url = "jdbc:derby:memory:sources;create=true"  # in a local session the one JVM is the server
    write_table(spark.range(-5, 40).select(F.col("id").cast("int"), (F.col("id") % 3).cast("int").alias("n")), url, "t")
    assert sorted(r.id for r in read_table(spark, url, "t", "id", 0, 32, 4).where("n = 1").collect()) == [i for i in range(-5, 40) if i > 0 and i % 3 == 1]


ROWS = [(-(2**63), "a", 1.5, True, b"\0"), (2**63 - 1, "", -0.5, False, b""), (7, "Ω `x` \"y\"", None, None, None), (7, None, 1e300, True, b"z"), (None, "no key", 0.0, None, None), (8, "a\0b", float("inf"), False, b"w")]


@pytest.mark.parametrize("parts", [1, 9])
def test_sqlite_rows(spark, tmp_path, parts):
    schema = "`the key` long, `na``me` string, x double, b boolean, c binary"
    path = f"file:{tmp_path}/new/a b%20?.db"
    write_sqlite(spark.createDataFrame(ROWS, schema), path, "t`t", "the key")
    got = read_sqlite(spark, path, "t`t", schema, "the key", parts)
    for where in ("true", "`the key` = 7", "`the key` is null", "`the key` <=> 8", "b", "not b", "x > 0", "x <= 0.0", "`na``me` in ('', 'a')", "`na``me` is not null and x is null", "`na``me` like 'a%'", "not (`the key` = 7)"):
        assert sorted(map(repr, got.where(where).collect())) == sorted(map(repr, spark.createDataFrame(ROWS, schema).where(where).collect())), where
    assert got.rdd.getNumPartitions() == parts
    assert os.listdir(tmp_path / "new") == ["a b%20?.db"]


def test_sqlite_filters_are_asked_of_the_database(spark, tmp_path):
    with sqlite3.connect(tmp_path / "t.db") as db:
        db.execute("CREATE TABLE t (id INTEGER, v)")
        db.executemany("INSERT INTO t VALUES (?, ?)", [(1, "no number"), (2, 20), (3, 30), (None, 40)])
    t = read_sqlite(spark, str(tmp_path / "t.db"), "t", "id long, v long", "id", 2)
    assert sorted(r.v for r in t.where("id >= 2").collect()) == [20, 30]  # the row that is no number is not read
    many = In(("id",), tuple(range(40_000)))  # more values than a statement takes
    reader = SqliteTable({"path": "t.db", "table": "t", "key": "id"}).reader(t.schema)
    assert list(reader.pushFilters([many, GreaterThan(("id",), 1), Not(IsNull(("v",)))])) == [many, Not(IsNull(("v",)))] and reader.values == [1]
    with pytest.raises(Exception, match="no such column"):
        read_sqlite(spark, str(tmp_path / "t.db"), "t", "id long, w long", "id", 2).collect()


def test_sqlite_is_whole_or_refused(spark, tmp_path):
    path = f"{tmp_path}/t.db"
    for empty in (spark.createDataFrame([], "id long, s string"), spark.range(5).select("id", F.lit("x").alias("s")).where("id > 9")):
        write_sqlite(empty, path, "t", "id")
        assert read_sqlite(spark, path, "t", "id long, s string", "id", 4).count() == 0
    write_sqlite(spark.range(50_000).select("id", F.lit("x").alias("s")), path, "t", "id")
    with pytest.raises(Exception, match="NaN"):
        write_sqlite(spark.createDataFrame([(1, float("nan"))], "id long, x double"), path, "t", "id")
    with pytest.raises(ValueError, match="d date"):
        write_sqlite(spark.sql("select 1 as id, current_date() as d"), path, "t", "id")
    with pytest.raises(ValueError, match="mounted"):
        write_sqlite(spark.range(1), "hdfs://host/t.db", "t", "id")
    found = read_sqlite(spark, path, "t", "id long", "id", 3)
    assert found.agg(F.count("*"), F.countDistinct("id"), F.sum("id")).first() == (50_000, 50_000, 50_000 * 49_999 // 2)
    assert os.listdir(tmp_path) == ["t.db"]
