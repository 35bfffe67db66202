"""Ranking, running and anomaly patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.scratch import Scratch


def first_per_key(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """The first row of each key; rows with a NULL key all stay. An aggregation over whole rows, no window."""
    keyed = df.withColumn("__k", key)
    row = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], F.struct(*df.columns).alias("__r"))
    first = keyed.where("__k is not null").groupBy("__k").agg(F.min(row).alias("m")).select("m.__r.*")
    return first.unionByName(keyed.where("__k is null").drop("__k"))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of an order: a top-k report, kept in one heap a partition."""
    return df.orderBy(*order).limit(k)


def top_k_per_key(df: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key. Spark cuts each partition's groups at ``k`` before the shuffle."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def cut_at_rate(df: DataFrame, group: str, order: Column, failed: Column, rate: float, least: int) -> DataFrame:
    """Attempts up to the first failed one at which failures are ``rate`` of ``least`` or more attempts of the group. Attempts are
    counted by ranges of the order and then inside a range, so that no task holds a group; a NULL group is one."""
    scratch = Scratch(df.sparkSession)
    ranged = df.withColumn("__o", order).withColumn("__x", F.coalesce(failed, F.lit(False)).cast("int")).repartitionByRange(group, "__o")
    placed = scratch.keep(ranged.withColumn("__part", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(group, "__part").agg(F.count("*").alias("__rows"), F.sum("__x").alias("__bad"))
    parts = parts.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__n0"), F.coalesce(F.sum("__bad").over(before), F.lit(0)).alias("__f0"))
    inside = Window.partitionBy(group, "__part").orderBy("__o")
    run = placed.withColumn("__n1", F.row_number().over(inside)).withColumn("__f1", F.sum("__x").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    run = run.join(parts, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p")))
    run = run.withColumn("__n", F.col("__n0") + F.col("__n1")).withColumn("__f", F.col("__f0") + F.col("__f1")).select(*df.columns, "__x", "__n", "__f")
    run = scratch.keep(run)
    stop = run.where((F.col("__x") == 1) & (F.col("__n") >= least) & (F.col("__f") >= rate * F.col("__n"))).groupBy(F.col(group).alias("__g")).agg(F.min("__n").alias("__s"))
    kept = run.join(stop, F.col(group).eqNullSafe(F.col("__g")), "left").where(F.col("__s").isNull() | (F.col("__n") <= F.col("__s")))
    return kept.select(*df.columns)


def within_budget(df: DataFrame, order: list[Column], budget: int) -> DataFrame:
    """Rows that a budget of ``budget`` calls covers, in order; 0 is no limit. ``allowed`` marks them; the others stay, so
    that nothing is lost. The threshold row is found by a top-k, not by a global window."""
    if budget <= 0:
        return df.withColumn("allowed", F.lit(True))
    key = F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)])
    last = df.select(key.alias("k")).orderBy("k").limit(budget).agg(F.max("k").alias("k")).first().k
    if last is None:
        return df.withColumn("allowed", F.lit(True))
    literal = F.struct(*[F.lit(v).alias(f"k{i}") for i, v in enumerate(last)])
    return df.withColumn("allowed", key <= literal)


def yield_state(n: Column, expected: Column) -> Column:
    """'low', 'high' or 'ok' of a count against an expected range 'low-high'; high is above twice the range; anything that
    is no range is 'ok'."""
    low = F.regexp_extract(expected, r"^\s*([0-9]+)\s*-\s*[0-9]+\s*$", 1).try_cast("int")
    high = F.regexp_extract(expected, r"^\s*[0-9]+\s*-\s*([0-9]+)\s*$", 1).try_cast("int")
    return F.when(n < low, "low").when(n > 2 * high, "high").otherwise("ok")
