"""Problem 5: changes between deliveries of raw_records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators.snapshot_diff import as_set, snapshot_changes, tidy
from corvane.plans.common import table


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Added, removed and changed (source, company_id) of deliveries 2 to 5, over all raw_records."""
    raw = table(spark, folder, "raw_records").where(F.col("company_id").isNotNull())
    return snapshot_changes(
        raw,
        keys={"source": F.col("source"), "company_id": F.lower(F.trim("company_id"))},
        fields=[tidy(F.col(c)) for c in ("name_raw", "description", "website", "location_raw")] + [as_set(F.col("tags"))],
        version="snapshot_no",
        latest="id",
    )


QUERIES = {"p5_found": p5_found}

_TIDY = r"coalesce(trim(regexp_replace({0}, '[\s\x0B\p{{Z}}]+', ' ', 'g')), '')"

SQL = {
    "p5_found": f"""
WITH cur AS (
  SELECT source, lower(trim(company_id)) AS company_id, snapshot_no,
         {_TIDY.format("name_raw")} AS a, {_TIDY.format("description")} AS b, {_TIDY.format("website")} AS c,
         {_TIDY.format("location_raw")} AS d,
         list_sort(list_distinct(list_transform(coalesce(CAST(try_cast(tags AS JSON) AS VARCHAR[]), []), lambda x: trim(x)))) AS e
  FROM raw_records WHERE company_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source, lower(trim(company_id)), snapshot_no ORDER BY id DESC) = 1
), prev AS (SELECT * REPLACE (snapshot_no + 1 AS snapshot_no) FROM cur)
SELECT coalesce(cur.source, prev.source) AS source, coalesce(cur.company_id, prev.company_id) AS company_id,
       CAST(coalesce(cur.snapshot_no, prev.snapshot_no) AS INTEGER) AS snapshot_no,
       CASE WHEN prev.company_id IS NULL THEN 'added' WHEN cur.company_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM cur FULL OUTER JOIN prev ON cur.source IS NOT DISTINCT FROM prev.source AND cur.company_id = prev.company_id AND cur.snapshot_no = prev.snapshot_no
WHERE coalesce(cur.snapshot_no, prev.snapshot_no) BETWEEN (SELECT min(snapshot_no) + 1 FROM raw_records) AND (SELECT max(snapshot_no) FROM raw_records)
  AND (prev.company_id IS NULL OR cur.company_id IS NULL
       OR (cur.a, cur.b, cur.c, cur.d, cur.e) IS DISTINCT FROM (prev.a, prev.b, prev.c, prev.d, prev.e))
"""
}
