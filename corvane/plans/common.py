"""Tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvane.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of the folder. Also ships the package, as queries may run Python workers."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
