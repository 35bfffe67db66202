"""Connected components by alternating large-star and small-star steps on long labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.scratch import Scratch


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(id, component) of all ends of ``edges``; the component is the smallest id. Loops and NULL ends are ignored."""
    scratch = Scratch(edges.sparkSession)
    now = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = scratch.keep(now.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m")).distinct()
        small = scratch.keep(small)
        mark = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        scratch.drop(now)
        now = small
        if mark == before:
            roots = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
        before = mark
    raise RuntimeError("components are not stable")
