"""Resolution joins: the latest, the best or the only row of a key, and what has no partner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: dict[str, Column], order: Column, values: list[str]) -> DataFrame:
    """One row a key, with ``values`` of the row that is highest in ``order`` (NULL lowest): an aggregation with map-side
    combine, no window over hot keys. Rows with a NULL key are left out."""
    named = df.select(*[k.alias(n) for n, k in keys.items()], F.struct(order.alias("__o"), *values).alias("__r"))
    named = named.where(" and ".join(f"`{n}` is not null" for n in keys))
    return named.groupBy(*keys).agg(F.max("__r").alias("__r")).select(*keys, *[F.col(f"__r.{v}") for v in values])


def best(df: DataFrame, keys: dict[str, Column], order: list[Column], values: list[str]) -> DataFrame:
    """One row a key, with ``values`` of the row that is lowest in ``order``."""
    named = df.select(*[k.alias(n) for n, k in keys.items()], F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *values).alias("__r"))
    named = named.where(" and ".join(f"`{n}` is not null" for n in keys))
    return named.groupBy(*keys).agg(F.min("__r").alias("__r")).select(*keys, *[F.col(f"__r.{v}") for v in values])


def attach(df: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    """Left join on equal keys; every row of ``df`` stays."""
    return df.join(found, on, "left")


def either_key(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], row_id: str) -> DataFrame:
    """Rows of ``left`` and ``right`` that are equal in any of the pairs of columns, each pair of rows once: one equi-join a
    pair and a union, never a join on OR."""
    parts = [left.join(right, F.col(a) == F.col(b)).select(left.columns + right.columns) for a, b in pairs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.dropDuplicates([row_id, *[c for c in right.columns if c.endswith("_rid")]])


def newest_kept_with_ties(df: DataFrame, key: str, order: str) -> DataFrame:
    """All rows whose ``order`` equals the highest of their key."""
    top = df.groupBy(key).agg(F.max(order).alias("__top"))
    return df.join(top, key).where(F.col(order) == F.col("__top")).drop("__top")


def not_in(df: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in ``done``."""
    return df.join(done.select(*on).distinct(), on, "left_anti")


def first_listed(text: Column, ordered: list[tuple[str, list[str]]]) -> Column:
    """The first name whose aliases contain the text or are contained in it, case ignored; NULL for an empty text."""
    t = F.lower(F.trim(text))
    hits = [F.when(F.greatest(*[t.contains(a.lower()) | F.lit(a.lower()).contains(t) for a in aliases], F.lit(False)), F.lit(name)) for name, aliases in ordered]
    return F.when(t != "", F.coalesce(*hits))


def priority_of(names: Column, ordered: list[str], unlisted: int = 999) -> Column:
    """Lowest position in ``ordered`` among an array of names; a name matches one that contains it or is contained in it."""
    known = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s.lower()).alias("s")) for i, s in enumerate(ordered)])
    rank = lambda n: F.array_min(F.transform(F.filter(known, lambda k: F.lower(n).contains(k["s"]) | k["s"].contains(F.lower(n))), lambda k: k["i"]))
    return F.coalesce(F.array_min(F.transform(names, rank)), F.lit(unlisted))
