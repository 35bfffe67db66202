"""Entity resolution: domain groups, blocked name similarity, components, canonical rows and their summary.

Rows at one domain are linked to the smallest of them, not to one another. Names are blocked by their first four
letters and by a first word of four letters or more; rows with equal name and sources are compared once. Two rows with a
source in common are never linked by name alone. Ties are settled by ``seq``, the load order.

A block with many names is not compared all with all: two texts whose ratio reaches the threshold differ by a bounded number
of insertions and deletions, so of that many segments of the shorter one and one more, one is in the longer one, near its place.
Names of such a block meet by segment; the pairs that come out are the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.similarity import indel_ratio, may_reach, sorted_tokens
from corvane.operators.graph import components
from corvane.scratch import Scratch


def star_edges(df: DataFrame, key: str, row: str) -> DataFrame:
    """(a, b): every row of a key with the smallest row of it; n - 1 edges for n rows."""
    low = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("__a"))
    return df.select(key, row).join(low, key).where(F.col("__a") != F.col(row)).select(F.col("__a").alias("a"), F.col(row).alias("b"))


def blocks(name: Column) -> Column:
    """Blocking keys of a normalised name."""
    first = F.split(name, " ")[0]
    keys = F.array(F.when(F.length(name) >= 4, F.concat(F.lit("4:"), F.substring(name, 1, 4))), F.when(F.length(first) >= 4, F.concat(F.lit("w:"), first)))
    return F.array_compact(keys)


def _cuts(length: int, apart: float) -> list[int]:
    """Where a text of a length is cut: into one segment more than the edits between it and the longest text that can be
    similar to it."""
    longest = int(length * (1 + apart) / (1 - apart) + 1e-9)
    pieces = int(apart * (length + longest) + 1e-9) + 1
    return [i * length // pieces for i in range(pieces + 1)]


def own_segments(text: str, apart: float) -> list[str]:
    """Keys of the segments of a text, the shorter of a pair."""
    cuts = _cuts(len(text), apart)
    return [f"{len(text)}|{i}|{text[cuts[i] : cuts[i + 1]]}" for i in range(len(cuts) - 1)]


def met_segments(text: str, apart: float) -> set[str]:
    """Keys of the parts of a text that can be segments of a shorter or equally long one, for every such length: a segment has
    moved by no more than the letters inserted before it, or deleted."""
    n, out = len(text), set()
    for m in range(max(1, math.ceil(n * (1 - apart) / (1 + apart) - 1e-9)), n + 1):
        edits, cuts = int(apart * (m + n) + 1e-9), _cuts(m, apart)
        fewer, more = (edits - (n - m)) // 2, (edits + (n - m)) // 2
        for i in range(len(cuts) - 1):
            size = cuts[i + 1] - cuts[i]
            out |= {f"{m}|{i}|{text[at : at + size]}" for at in range(max(cuts[i] - fewer, 0), min(cuts[i] + more, n - size) + 1)}
    return out


def _keys(rows: DataFrame, segments, apart: float) -> DataFrame:
    """(g, k, s) of ``rows(g, t, k)``: the keys that ``segments`` gives for the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                out = [(g, k, s) for g, t, k in zip(part["g"], part["t"], part["k"]) for s in segments(t, apart)]
                yield pd.DataFrame(out, columns=["g", "k", "s"])

    return rows.mapInPandas(run, f"g {rows.schema['g'].dataType.simpleString()}, k string, s string")


def blocked_pairs(groups: DataFrame, name: str, text: str, threshold: float, crowd: int, scratch: Scratch) -> DataFrame:
    """(g, h), g < h, of ``groups(g, name, text)`` that share a block and whose texts may reach the threshold. Blocks of more than
    ``crowd`` names meet by segments of the text."""
    keyed = groups.select("g", F.col(text).alias("t"), F.explode(blocks(F.col(name))).alias("k"))
    crowded = scratch.keep(keyed.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("k"))
    some = not crowded.isEmpty()
    few = (keyed.join(crowded, "k", "left_anti") if some else keyed).select("g", "k")
    pairs = few.hint("merge").join(few.withColumnRenamed("g", "h"), "k").where("g < h").select("g", "h")
    if not some:
        return pairs.distinct()
    many = keyed.join(crowded, "k", "left_semi").where(F.length("t") > 0).select("g", "t", "k")
    own, met = _keys(many, own_segments, 1 - threshold / 100), _keys(many, met_segments, 1 - threshold / 100).withColumnRenamed("g", "h")
    by_segment = own.hint("merge").join(met, ["k", "s"]).where("g <> h").select(F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h"))
    return pairs.union(by_segment).distinct()


def similar_names(df: DataFrame, name: str, sources: str, row: str, threshold: float, scratch: Scratch, crowd: int = 1000) -> DataFrame:
    """(a, b) between representatives of equal (name, sources), plus every row with its representative where that one is
    linked: as linked as comparing all rows, without comparing copies."""
    df = df.where(F.coalesce(F.col(name) != "", F.lit(False))).withColumn("__s", F.array_sort(F.array_distinct(F.coalesce(F.col(sources), F.array().cast("array<string>")))))
    groups = df.groupBy(name, "__s").agg(F.min(row).alias("g"), F.count("*").alias("__n"))
    groups = scratch.keep(groups.withColumn("t", sorted_tokens(F.col(name))))
    pairs = blocked_pairs(groups, name, "t", threshold, crowd, scratch)
    left = groups.select("g", F.col("t").alias("t1"), F.col("__s").alias("s1"))
    right = groups.select(F.col("g").alias("h"), F.col("t").alias("t2"), F.col("__s").alias("s2"))
    near = pairs.join(left, "g").join(right, "h").where(~F.coalesce(F.arrays_overlap("s1", "s2"), F.lit(False)) & may_reach(F.col("t1"), F.col("t2"), threshold))
    near = scratch.keep(near.where(indel_ratio("t1", "t2") >= threshold).select(F.col("g").alias("a"), F.col("h").alias("b")))
    loose = groups.where((F.size("__s") == 0) & (F.col("__n") > 1)).select("g")
    linked = near.select(F.col("a").alias("g")).union(near.select("b")).union(loose).distinct()
    copies = df.join(groups.join(linked, "g", "left_semi").select(name, "__s", "g"), [name, "__s"]).where(F.col("g") != F.col(row))
    return near.union(copies.select("g", row))


def resolve(df: DataFrame, *, row: str, name: str, domain: str, sources: str, order: list[Column], threshold: float = 88.0) -> DataFrame:
    """(row, canonical, is_duplicate, match_type) of all rows.

    The canonical row of a component is the first by ``order``, then by ``row``. ``match_type`` is 'domain' if any link of
    the component is, else 'fuzzy_name'; NULL for a row of its own. ``order`` and ``row`` decide all ties.
    """
    scratch = Scratch(df.sparkSession)
    df = scratch.keep(df.withColumn("__o", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(row).alias("row"))))
    by_domain = scratch.keep(star_edges(df, domain, row))
    by_name = similar_names(df, name, sources, row, threshold, scratch)
    links = scratch.keep(by_domain.union(by_name))
    groups = scratch.keep(components(links, "a", "b").select(F.col("id").alias("__id"), F.col("component").alias("__component")))
    at_domain = by_domain.select(F.col("a").alias("__id")).join(groups, "__id").select("__component").distinct().withColumn("__at", F.lit(True))
    members = df.join(groups, F.col(row) == F.col("__id")).select("__component", "__o")
    first = members.groupBy("__component").agg(F.min("__o").alias("m")).select("__component", F.col("m.row").alias("__canonical"))
    info = first.join(at_domain, "__component", "left")
    placed = groups.join(info, "__component").select("__id", "__canonical", F.when(F.col("__at"), "domain").otherwise("fuzzy_name").alias("__type"))
    out = df.select(row).join(placed, F.col(row) == F.col("__id"), "left")
    return out.select(row, F.coalesce("__canonical", row).alias("canonical"), F.coalesce((F.col("__canonical") != F.col(row)).cast("int"), F.lit(0)).alias("is_duplicate"), F.col("__type").alias("match_type"))


def merged_sources(df: DataFrame, resolved: DataFrame, row: str, sources: str) -> DataFrame:
    """(canonical, merged): the union of a component's sources in row order, without repetition. A component's different
    sources are bounded by the number of sources."""
    each = df.join(resolved.select(row, "canonical"), row).select("canonical", row, F.posexplode(sources))
    first = each.groupBy("canonical", "col").agg(F.min(F.struct(row, "pos")).alias("at"))
    return first.groupBy("canonical").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "col"))), lambda x: x["col"]).alias("merged"))


def resolution_summary(resolved: DataFrame, domain_rows: DataFrame, domain: str, row: str, links: DataFrame | None = None) -> DataFrame:
    """One row: rows before and after, duplicates, merged components and domain unions (n - 1 for n rows at a domain)."""
    counts = resolved.agg(F.count("*").alias("before_count"), F.count_if(F.col("is_duplicate") == 0).alias("after_count"), F.count_if(F.col("is_duplicate") == 1).alias("duplicates"), F.count_distinct(F.when(F.col("match_type").isNotNull(), F.col("canonical"))).alias("merges"))
    unions = domain_rows.where(F.col(domain).isNotNull()).groupBy(domain).agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("domain_unions"))
    return counts.withColumn("__k", F.lit(1)).join(unions.withColumn("__k", F.lit(1)), "__k").drop("__k")


def ordered_prefix_dedupe(names: list[str], least: int = 5) -> list[bool]:
    """Which names of one short ordered list are new: none before is equal or a word-prefix either way."""
    seen: list[str] = []
    out = []
    for n in names:
        new = not any(n == s or (len(min(n, s, key=len)) >= least and max(n, s, key=len).startswith(min(n, s, key=len) + " ")) for s in seen)
        out.append(new)
        if new:
            seen.append(n)
    return out
