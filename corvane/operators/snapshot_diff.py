"""What changed between full snapshots of one table.

Method: every delivery is reduced to one canonical row hash for each primary key, then consecutive
deliveries are joined with a full outer join on the key. A missing side is an addition or a removal,
unequal hashes are a change. Only the key, the delivery number and two 64-bit hashes are shuffled; texts
stay in the scan. Repeated keys are reduced before the shuffle, so a hot key costs one row a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for NULL inside a text key, so that the key stays a plain equi-join key.
NULL_KEY = "\x00"


def tidy(value: Column) -> Column:
    """White space trimmed and collapsed; NULL and empty become the empty text."""
    return F.coalesce(F.trim(F.regexp_replace(value, r"[\s\p{Z}]+", " ")), F.lit(""))


def as_set(value: Column) -> Column:
    """A JSON array of texts as a sorted set; NULL, empty and ``[]`` are equal; a text that is no JSON array
    is a set of itself."""
    parsed = F.from_json(value, "array<string>")
    own = F.when(tidy(value) == "", F.array().cast("array<string>")).otherwise(F.array(tidy(value)))
    return F.sort_array(F.array_distinct(F.transform(F.coalesce(parsed, own), tidy)))


def row_hash(fields: list[Column], seed: int) -> Column:
    """Canonical hash of normalised fields, none of them NULL."""
    return F.xxhash64(F.lit(seed), *fields)


def snapshot_changes(
    df: DataFrame, *, keys: dict[str, Column], fields: list[Column], version: str, latest: str
) -> DataFrame:
    """Added, removed and changed keys of each delivery against the one before.

    ``keys`` gives the primary key's columns by output name, ``fields`` the normalised columns that count
    (not NULL), ``version`` the delivery number, ``latest`` the column whose highest value wins where a key
    repeats in a delivery. Returns the key's columns, ``version`` and ``change``.

    Rows with a NULL delivery number belong to no delivery and are left out. A NULL in a key column is a
    value of its own. Rows equal in ``latest`` (NULL is lowest) are settled by the larger hash. Deliveries
    are numbered consecutively; a number that is missing between the first and the last is an empty
    delivery. An empty table, or one with a single delivery, gives no rows.
    """
    keys = {k: F.coalesce(c.cast("string"), F.lit(NULL_KEY)) for k, c in keys.items()}
    names = [f"__k_{k}" for k in keys]
    rows = df.where(F.col(version).isNotNull())
    bounds = rows.agg(F.min(version).alias("a"), F.max(version).alias("b")).first()
    first, last = (0, 0) if bounds.a is None else (int(bounds.a), int(bounds.b))
    order = F.coalesce(F.col(latest).cast("long"), F.lit(-(2**63)))
    now = (
        rows.select(
            *[c.alias(n) for n, c in zip(names, keys.values())],
            F.col(version).cast("long").alias("__v"),
            order.alias("__at"),
            row_hash(fields, 7).alias("__h"),
            row_hash(fields, 104729).alias("__g"),
        )
        .groupBy(*names, "__v")
        .agg(F.max(F.struct("__at", "__h", "__g")).alias("__r"))
        .select(*names, "__v", "__r.__h", "__r.__g")
    )
    then = now.select(*names, (F.col("__v") + 1).alias("__v"), F.col("__h").alias("__ph"), F.col("__g").alias("__pg"))
    both = now.join(then, [*names, "__v"], "full_outer")
    change = (
        F.when(F.col("__ph").isNull(), "added")
        .when(F.col("__h").isNull(), "removed")
        .when((F.col("__h") != F.col("__ph")) | (F.col("__g") != F.col("__pg")), "changed")
    )
    out = both.withColumn("change", change).where(
        F.col("change").isNotNull() & F.col("__v").between(F.lit(first + 1), F.lit(last))
    )
    plain = [F.when(F.col(n) != NULL_KEY, F.col(n)).alias(k) for n, k in zip(names, keys)]
    return out.select(*plain, F.col("__v").cast(df.schema[version].dataType).alias(version), "change")
