"""Keyed writers over immutable snapshots: every function returns the next snapshot, ``save`` writes it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def insert_or_ignore(existing: DataFrame, new: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """``existing`` and those new rows whose key is not there; among new rows of one key the first by ``order`` (else the
    smallest row) is taken. NULL keys are distinct, as in a unique index."""
    row = F.struct(*([order.alias("__o")] if order is not None else []), *[c for c in new.columns if new.schema[c].dataType.typeName() != "map"])
    whole = F.struct(*new.columns)
    has = " and ".join(f"`{k}` is not null" for k in keys)
    fresh = new.where(has).groupBy(*keys).agg(F.min_by(whole, row).alias("__r")).select("__r.*")
    fresh = fresh.join(existing.select(*keys), keys, "left_anti").select(*new.columns)
    return existing.unionByName(fresh, allowMissingColumns=True).unionByName(new.where(f"not ({has})"), allowMissingColumns=True)


def insert_or_replace(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` without the keys of ``new``, and ``new``."""
    return existing.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def update_columns(existing: DataFrame, changes: DataFrame, key: str, columns: list[str], when: Column | None = None) -> DataFrame:
    """Columns set to the non-NULL values of ``changes`` (one row a key), where ``when`` holds in the old row."""
    new = changes.select(F.col(key), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in columns])
    joined = existing.join(new, key, "left")
    guard = F.coalesce(F.col("__hit"), F.lit(False)) & (when if when is not None else F.lit(True))
    return joined.select(*[F.when(guard, F.coalesce(f"__new_{c}", c)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in existing.columns])


def fill_columns(existing: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """As ``update_columns``, each column only where it was NULL."""
    new = changes.select(F.col(key), *[F.col(c).alias(f"__new_{c}") for c in columns])
    joined = existing.join(new, key, "left")
    return joined.select(*[F.coalesce(c, f"__new_{c}").alias(c) if c in columns else F.col(c) for c in existing.columns])


def migrate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` it lacks, as NULL; idempotent, additive."""
    have = set(df.columns)
    return df.select(*df.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in have])


def save(df: DataFrame, path: str, *, mode: str = "append", partition: str | None = None, kind: str = "parquet") -> None:
    """Write a snapshot (parquet, json, csv with a header)."""
    writer = df.write.mode(mode)
    writer = writer.partitionBy(partition) if partition else writer
    getattr(writer.option("header", True) if kind == "csv" else writer, kind)(path)


def normalised_edges(edges: DataFrame, person: str, lower: bool, confidence: float = 0.8) -> DataFrame:
    """Edges ready to insert: the name trimmed (and lower-case), a missing confidence filled."""
    name = F.trim(person)
    return edges.withColumn(person, F.lower(name) if lower else name).withColumn("confidence", F.coalesce("confidence", F.lit(confidence)))


def run_rates(df: DataFrame) -> DataFrame:
    """Rates of a run, NULL where the denominator is 0."""
    return df.select(
        "*",
        F.try_divide("venture_scale", "total_records").alias("r_pass"),
        F.try_divide("manually_demoted", "venture_scale").alias("r_false_positive"),
        F.try_divide(F.col("manually_promoted"), F.col("borderline") + F.col("not_venture_scale")).alias("r_false_negative"),
    )


def structured(df: DataFrame, key: str, display: str, members: list[str]) -> DataFrame:
    """One row a key with its members as an array in order of their columns: the shape of a saved JSON dimension."""
    return df.groupBy(key).agg(F.min(display).alias("canonical_name"), F.array_sort(F.collect_set(F.struct(*members))).alias("members"))


def display_list(items: Column, name: str, role: str, note: str) -> Column:
    """Structs as 'Name (role) - note; ...' for a spreadsheet cell."""
    one = lambda x: F.concat(x[name], F.when(F.coalesce(x[role], F.lit("")) != "", F.concat(F.lit(" ("), x[role], F.lit(")"))).otherwise(""), F.when(F.coalesce(x[note], F.lit("")) != "", F.concat(F.lit(" - "), x[note])).otherwise(""))
    return F.array_join(F.transform(items, one), "; ")
