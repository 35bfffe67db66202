"""Paged and per-key reads from services, behind a fetch function, so that tests and landed responses need no network."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class RateLimiter:
    """At least ``gap`` seconds between two calls of ``wait`` in one process."""

    def __init__(self, gap: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.clock, self.sleep = gap, clock, sleep
        self.last: float | None = None

    def wait(self) -> None:
        if self.last is not None and (left := self.gap - (self.clock() - self.last)) > 0:
            self.sleep(left)
        self.last = self.clock()


def read_until_short(fetch: Callable[[int, int], list], size: int, most: int) -> Iterator:
    """Items of pages of ``size`` until one is short or ``most`` items are offset."""
    offset = 0
    while offset < most:
        page = fetch(offset, size)
        yield from page
        if len(page) < size:
            return
        offset += size


class _Page(InputPartition):
    def __init__(self, url: str):
        self.url = url


class LandedPages(DataSource):
    """``spark.read.format("landed_pages").option("urls", "a\\nb")``: one partition a URL or file, read as text; a page that
    cannot be read is a row with an error instead of a failed job."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return "url string, body string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.gap = float(options.get("gap", "0"))

    def partitions(self):
        return [_Page(u) for u in self.urls]

    def read(self, partition):
        from urllib.request import urlopen

        RateLimiter(self.gap).wait()
        try:
            url = partition.url if "://" in partition.url else f"file://{partition.url}"
            with urlopen(url, timeout=20) as r:  # noqa: S310
                yield (partition.url, r.read().decode("utf-8", "replace"), None)
        except Exception as e:  # noqa: BLE001
            yield (partition.url, None, type(e).__name__)


def first_platform(parts: list[DataFrame], key: str) -> DataFrame:
    """For each key the row of the first platform that has one; all parts have the same columns."""
    ranked = [p.withColumn("platform_rank", F.lit(i)) for i, p in enumerate(parts)]
    union = ranked[0]
    for p in ranked[1:]:
        union = union.unionByName(p)
    values = [c for c in union.columns if c != key]
    return union.groupBy(key).agg(F.min_by(F.struct(*values), "platform_rank").alias("r")).select(key, "r.*")


def candidate_pages(sites: DataFrame, pages: DataFrame, site: str, paths: list[str], least: int = 500) -> DataFrame:
    """(site, url, text) of the first path, in order, whose page was read with status 200 and has ``least`` characters.
    ``pages(url, status, text)`` are landed responses."""
    tried = sites.select(site, F.posexplode(F.array(*[F.lit(p) for p in paths])).alias("pos", "path")).withColumn("url", F.concat(site, "path"))
    good = pages.where((F.col("status") == 200) & (F.length(F.trim("text")) >= least)).select("url", "text")
    return tried.hint("merge").join(good, "url").groupBy(site).agg(F.min_by(F.struct("url", "text"), "pos").alias("r")).select(site, "r.*")


def lookup_first(keys: DataFrame, responses: DataFrame, key: str, shape: str) -> DataFrame:
    """Left join on landed JSON responses ``(key, body)``: success, number of hits, first hit and all hits. Keys without a
    readable, successful response have no hits."""
    parsed = responses.select(key, F.from_json("body", f"success boolean, data array<{shape}>").alias("r"))
    parsed = parsed.select(key, F.when(F.col("r.success"), F.col("r.data")).alias("hits"))
    out = keys.join(parsed, key, "left")
    return out.withColumn("n_hits", F.coalesce(F.size("hits"), F.lit(0))).withColumn("first_hit", F.get("hits", F.lit(0)))


def job_rollup(jobs: DataFrame, key: str, title: str, location: str, keywords: list[str], titles: int = 10) -> DataFrame:
    """Jobs of each key: all, local, remote, and the first ``titles`` local titles in posting order (``seq``)."""
    local = F.coalesce(F.lower(location).rlike("|".join(keywords)), F.lit(False))
    remote = F.coalesce(F.lower(location).contains("remote"), F.lit(False))
    ranked = jobs.withColumn("__l", local).withColumn("__r", remote)
    counts = ranked.groupBy(key).agg(F.count("*").alias("n_jobs"), F.count_if("__l").alias("n_local"), F.count_if("__r").alias("n_remote"))
    from corvane.operators.rank import top_k_per_key

    firsts = top_k_per_key(ranked.where("__l"), key, [F.col("seq")], titles).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", title))).alias("t"))
    return counts.join(firsts.select(key, F.transform("t", lambda x: x[title]).alias("titles")), key, "left")


def with_fallback(df: DataFrame, defaults: dict) -> DataFrame:
    """``df`` with defaults where a column is NULL: a detail that could not be read does not lose its row."""
    return df.select(*[F.coalesce(c, defaults[c]).alias(c) if c in defaults else F.col(c) for c in df.columns])


class PagedSearch(DataSource):
    """``spark.read.format("paged_search").option("folder", f).option("size", n)``: the items of landed searches, one partition a
    folder ``part=...``; each is read in pages of ``size`` items until one is short or ``most`` are offset."""

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return "part string, item string"

    def reader(self, schema) -> DataSourceReader:
        return _SearchReader(self.options)


class _SearchReader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.size = options["folder"].removeprefix("file:"), int(options.get("size", "100"))
        self.most = int(options.get("most", str(2**62)))

    def partitions(self):
        import glob

        return [_Page(p) for p in sorted(glob.glob(f"{self.folder}/part=*"))]

    def read(self, partition):
        import glob
        from itertools import islice

        def lines():
            for path in sorted(glob.glob(f"{partition.url}/*.txt")):
                with open(path, encoding="utf-8") as f:
                    yield from (line.rstrip("\n") for line in f)

        landed = lines()
        part = partition.url.rpartition("=")[2]
        for item in read_until_short(lambda offset, size: list(islice(landed, size)), self.size, self.most):
            yield (part, item)
