"""Problem 9: documents decoded with a wrong encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm.mojibake import find_garbled
from corvane.plans.common import table


def p9_restored(spark: SparkSession, folder: str) -> DataFrame:
    """Garbled documents with their restored text and the operations that led to it, over all whole texts."""
    return find_garbled(table(spark, folder, "documents"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents garbled wholly or in any passage."""
    return p9_restored(spark, folder).select("doc_id")


QUERIES = {"p9_found": p9_found, "p9_restored": p9_restored}
SQL: dict[str, str] = {}
