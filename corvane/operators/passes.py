"""Passes over a store: fill what is missing, once, with a record of what ran; running summaries and ranked reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.text import absent


@dataclass
class Pass:
    """A column and what to put there where it is missing; ``force`` puts it there anyway."""

    column: str
    value: Column
    force: bool = False


def run_missing(df: DataFrame, steps: list[Pass]) -> DataFrame:
    """``df`` with the columns of all passes and ``ran``, the names of those that had work for the row. NULL, and for texts the empty
    one, is missing; a pass whose value is NULL leaves the column and has run all the same. All passes see the row as it
    was, so one scan does them, and a second run finds nothing to do."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    lacks = {s.column: F.lit(True) if s.force else absent(s.column) if kinds[s.column] == "string" else F.col(s.column).isNull() for s in steps}
    new = {s.column: F.when(lacks[s.column], F.coalesce(s.value, F.col(s.column))).otherwise(F.col(s.column)).alias(s.column) for s in steps}
    ran = F.array_compact(F.array(*[F.when(lacks[s.column], F.lit(s.column)) for s in steps]))
    return df.select(*[new.get(c, F.col(c)) for c in df.columns if c != "ran"], ran.alias("ran"))


def running_summary(df: DataFrame, group: str, order: Column, failed: Column, samples: int) -> DataFrame:
    """(group, n_runs, n_failed, worst_rate, sample) of attempts in ``order``: the highest failure rate reached along the way and
    the first ``samples`` of ``order``. The window streams through a group and spills; it holds none in memory."""
    w = Window.partitionBy(group).orderBy("__o")
    run = df.select(group, order.alias("__o"), failed.cast("int").alias("__x")).withColumn("__n", F.row_number().over(w))
    run = run.withColumn("__f", F.sum("__x").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # only the first ones are collected, so the array is bounded
    first = F.sort_array(F.collect_list(F.when(F.col("__n") <= samples, F.col("__o"))))
    return run.groupBy(group).agg(F.count("*").alias("n_runs"), F.sum("__x").alias("n_failed"), F.max(F.col("__f") / F.col("__n")).alias("worst_rate"), first.alias("sample"))


def ranked_report(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of an order with their ``rank``. The rank is worked out over those rows only."""
    top = df.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)).cast("long"))
