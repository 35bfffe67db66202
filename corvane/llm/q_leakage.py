"""Problem 7: evaluation items inside documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm.leakage import Leaks
from corvane.plans.common import table


def _leaks(spark: SparkSession, folder: str) -> Leaks:
    return Leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold at least 13 consecutive words of an item, over all whole texts."""
    return _leaks(spark, folder).verbatim()


def p7_reparam(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold an item with other names or numbers in its slots."""
    return _leaks(spark, folder).reparameterised()


QUERIES = {"p7_found": p7_found, "p7_reparam": p7_reparam}

_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"

SQL = {
    "p7_found": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), e AS (SELECT item_id, {_WORDS} AS w FROM eval_items),
dw AS (SELECT doc_id, array_to_string(w[i:i+12], ' ') AS g FROM d, range(1, greatest(len(w) - 11, 1)) AS r(i)),
ew AS (SELECT item_id, array_to_string(w[i:i+12], ' ') AS g FROM e, range(1, greatest(len(w) - 11, 1)) AS r(i))
SELECT DISTINCT doc_id, item_id FROM dw JOIN ew USING (g)
"""
}
