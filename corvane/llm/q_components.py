"""Problem 3: one group id for all companies linked by pointers and matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.components import connected_components
from corvane.plans.common import table


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Groups over all pointers of companies and all matched rows of match_pairs. A match without a type is a match."""
    companies = table(spark, folder, "companies").select("id", "canonical_id")
    pointers = companies.select(F.col("id").alias("a"), F.lower(F.trim("canonical_id")).alias("b")).where("b <> ''")
    kind = F.coalesce(F.lower(F.trim("dedup_match_type")), F.lit(""))
    matches = table(spark, folder, "match_pairs").where(kind != "none").select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))
    links = pointers.unionByName(matches).where("a <> b")
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ids = companies.select("id")
    known = links.join(ids.withColumnRenamed("id", "a"), "a", "left_semi").join(ids.withColumnRenamed("id", "b"), "b", "left_semi")
    return connected_components(known, "a", "b").select(F.col("id").alias("company_id"), "group_id")


QUERIES = {"p3_found": p3_found}

SQL = {
    "p3_found": """
WITH RECURSIVE links AS (
  SELECT a, b FROM (SELECT id AS a, lower(trim(canonical_id)) AS b FROM companies
                    UNION SELECT left_id, right_id FROM match_pairs WHERE coalesce(lower(trim(dedup_match_type)), '') <> 'none')
  WHERE a <> b AND a IN (SELECT id FROM companies) AND b IN (SELECT id FROM companies)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT a AS company_id, min(b) AS group_id FROM reach GROUP BY a
"""
}
