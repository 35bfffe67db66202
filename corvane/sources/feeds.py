"""Feeds and files: RSS, JSON, JSON inside pages, worksheets, text blocks, JSON lines, source lists."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEM_SCHEMA = "title string, link string, description string, pubDate string, `dc:creator` string, category array<string>"


def read_rss(spark: SparkSession, path: str) -> DataFrame:
    """Items of RSS files; a file that is no XML gives none."""
    return spark.read.format("xml").option("rowTag", "item").option("mode", "DROPMALFORMED").schema(ITEM_SCHEMA).load(path)


def rss_items(texts: DataFrame, text: str = "xml") -> DataFrame:
    """The same from a column of feeds, with the place of an item in its feed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for source in batch[text]:
                try:
                    items = ElementTree.fromstring(source).findall(".//item") if isinstance(source, str) else []
                except ElementTree.ParseError:
                    items = []
                for i, item in enumerate(items):
                    get = lambda tag: (item.findtext(tag) or "").strip()  # noqa: B023, E731
                    rows.append((i, get("title"), get("link"), get("description"), get("pubDate"), get("{http://purl.org/dc/elements/1.1/}creator"), [c.text.strip() for c in item.findall("category") if c.text and c.text.strip()]))
            yield pd.DataFrame(rows, columns=["seq", "title", "link", "description", "published", "creator", "categories"])

    return texts.select(text).mapInPandas(run, "seq int, title string, link string, description string, published string, creator string, categories array<string>")


def filings(hits: DataFrame, json_column: str) -> DataFrame:
    """Hits of a search response: one row each, with NULL for what is missing."""
    source = "struct<display_names:array<string>,adsh:string,ciks:array<string>,file_date:string,biz_locations:array<string>,items:array<string>>"
    shape = f"hits struct<hits:array<struct<_source:{source}>>>"
    rows = hits.select(F.posexplode(F.from_json(json_column, shape)["hits"]["hits"]).alias("seq", "h")).select("seq", "h._source.*")
    at = lambda c: F.get(F.col(c), F.lit(0))
    return rows.select("seq", at("display_names").alias("display_name"), "adsh", at("ciks").alias("cik"), "file_date", at("biz_locations").alias("location"), "items")


def embedded_state(page: str | None, marker: str) -> object | None:
    """The JSON value that follows ``marker`` in a page; None if there is none that can be read."""
    if not isinstance(page, str) or marker not in page:
        return None
    at = page.find("{", page.index(marker))
    try:
        return json.JSONDecoder().raw_decode(page[at:])[0] if at >= 0 else None
    except ValueError:
        return None


def find_objects(tree: object, kind: str) -> list[dict]:
    """All objects whose system.type is ``kind``, in order; a match is not searched for further ones."""
    out, stack = [], [tree]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            system = x.get("system")
            if isinstance(system, dict) and system.get("type") == kind:
                out.append(x)
            else:
                stack.extend(reversed(list(x.values())))
        elif isinstance(x, list):
            stack.extend(reversed(x))
    return out


def embedded_objects(pages: DataFrame, page_id: str, html: str, marker: str, kind: str) -> DataFrame:
    """(page_id, seq, object): objects of a kind inside the pages' embedded state, as JSON."""
    id_type = pages.schema[page_id].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, i, json.dumps(o)) for k, h in zip(batch[page_id], batch[html]) for i, o in enumerate(find_objects(embedded_state(h, marker), kind))]
            yield pd.DataFrame(rows, columns=[page_id, "seq", "object"])

    return pages.select(page_id, html).mapInPandas(run, f"{page_id} {id_type}, seq int, object string")


MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def worksheet_rows(content: bytes, sheet: str) -> list[list[str | None]]:
    """Cells of a worksheet by row, as text; [] if the workbook has no such sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        rels = {r.attrib["Id"]: r.attrib["Target"] for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = next((rels[s.attrib[REL]] for s in book.iter(f"{MAIN}sheet") if s.attrib["name"] == sheet), None)
        if target is None:
            return []
        out = []
        for row in ElementTree.fromstring(z.read("xl/" + target.lstrip("/").removeprefix("xl/"))).iter(f"{MAIN}row"):
            cells: list[str | None] = []
            for c in row.iter(f"{MAIN}c"):
                letters = re.match(r"[A-Z]+", c.attrib.get("r", "")) or re.match("", "")
                at = 0
                for ch in letters.group():
                    at = at * 26 + ord(ch) - 64
                while len(cells) < max(at - 1, 0):
                    cells.append(None)
                v, kind = c.find(f"{MAIN}v"), c.attrib.get("t")
                if kind == "inlineStr":
                    cells.append("".join(t.text or "" for t in c.iter(f"{MAIN}t")))
                else:
                    cells.append(None if v is None else shared[int(v.text)] if kind == "s" else v.text)
            out.append(cells)
        return out


def scan_worksheets(files: DataFrame, sheets: list[str], columns: list[str]) -> DataFrame:
    """(path, sheet, seq, columns) of ``files(path, content)``: rows of the named sheets, cells by position. Files that are no
    workbook give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                for sheet in sheets:
                    try:
                        cells = worksheet_rows(bytes(content), sheet)
                    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                        cells = []
                    rows += [(path, sheet, i, *(r + [None] * len(columns))[: len(columns)]) for i, r in enumerate(cells)]
            yield pd.DataFrame(rows, columns=["path", "sheet", "seq", *columns])

    return files.select("path", "content").mapInPandas(run, "path string, sheet string, seq int, " + ", ".join(f"{c} string" for c in columns))


def queue_rows(rows: DataFrame, zone: str, phase_sheet: str) -> DataFrame:
    """Rows of an interconnection queue: those below the header whose number looks like one, of a zone, with an entity; on
    ``phase_sheet`` the phase must show a signed agreement."""
    keep = F.col("number").rlike(r"^[0-9]{2}INR[0-9]{4}") & (F.upper(F.trim("zone")) == zone) & (F.trim("entity") != "")
    signed = (F.col("sheet") != phase_sheet) | F.coalesce(F.upper("phase").contains("IA"), F.lit(False))
    return rows.where(keep & signed)


def text_blocks(texts: DataFrame, text: str, headers: list[str], default_role: str) -> DataFrame:
    """Blocks between blank lines as (seq, name, company, role): two lines or more, no header, default role. ``texts`` is a
    column of whole files."""
    block = texts.select(F.posexplode(F.split(text, r"\n\s*\n")).alias("seq", "b"))
    lines = F.filter(F.transform(F.split("b", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    at = lambda i: F.get(F.col("lines"), F.lit(i))
    out = block.select("seq", lines.alias("lines")).where(F.size("lines") >= 2).select("seq", at(0).alias("name"), at(1).alias("company"), F.coalesce(at(2), F.lit(default_role)).alias("role"))
    return out.where(~F.lower("name").isin([h.lower() for h in headers]) & (F.lower("company") != default_role.lower()))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, valid: str | None = None) -> DataFrame:
    """Valid lines of JSON files: blank lines and lines that do not parse, or fail ``valid``, are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())]), {"columnNameOfCorruptRecord": "_corrupt"}).alias("r")).select("r.*")
    parsed = parsed.where("_corrupt is null").drop("_corrupt")
    return parsed.where(valid) if valid else parsed


def source_list(text: str) -> list[dict[str, str]]:
    """Entries of a flat YAML list of ``- key: value`` blocks; enough for a list of sources."""
    out: list[dict[str, str]] = []
    for line in text.splitlines():
        m = re.match(r"^(\s*)(-\s+)?([\w-]+):\s*(.*?)\s*(?:\s#.*)?$", line)
        if not m or line.lstrip().startswith("#"):
            continue
        if m.group(2):
            out.append({})
        if out and m.group(4):
            out[-1][m.group(3)] = m.group(4).strip("'\"")
    return out
