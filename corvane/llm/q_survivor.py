"""Problem 1: one surviving record of each group of companies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.survivor import duplicate_groups, instant, present_text, source_names, survivors, trust_of, truth_discovery, valid_score
from corvane.plans.common import table

TEXTS = ("canonical_domain", "website", "summary")


def _members(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "companies").select("id", "canonical_id", "source_ids", "venture_scale_score", "first_seen_at", *TEXTS)
    return duplicate_groups(rows, "id", "canonical_id")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The row that each field of each group is taken from, over all companies."""
    members = _members(spark, folder).select(
        "group_id", "id", "source_ids",
        *[present_text(c).alias(c) for c in TEXTS],
        valid_score("venture_scale_score").alias("scored"),
        F.when(valid_score("venture_scale_score"), F.col("venture_scale_score")).otherwise(F.lit(0.0)).alias("score"),
        instant("first_seen_at").alias("seen"),
    )
    members = trust_of(members, table(spark, folder, "source_registry"), "id", "source_ids")
    seen = F.coalesce("seen", F.lit(2**63 - 1))
    order = [F.col("trust"), -F.col("score"), seen]
    fields = {"record": (F.lit(True), []), **{c: (F.col(c), []) for c in TEXTS}}
    fields |= {"venture_scale_score": (F.col("scored"), []), "first_seen_at": (F.col("seen").isNotNull(), [F.col("seen")])}
    return survivors(members, "id", order, fields)


def _claims(spark: SparkSession, folder: str) -> DataFrame:
    rows = _members(spark, folder)
    score = F.when(valid_score("venture_scale_score"), F.format_string("%.1f", "venture_scale_score"))
    values = [F.struct(F.lit(c).alias("field_name"), F.when(present_text(c), F.lower(F.trim(c))).alias("value")) for c in TEXTS]
    values += [
        F.struct(F.lit("venture_scale_score").alias("field_name"), score.alias("value")),
        F.struct(F.lit("first_seen_at").alias("field_name"), F.date_format(F.timestamp_micros(instant("first_seen_at")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("value")),
    ]
    rows = rows.select("group_id", source_names("source_ids").alias("s"), F.explode(F.array(*values)).alias("v"))
    return rows.select("group_id", "v.*", F.explode_outer("s").alias("source"))


def p1_truth(spark: SparkSession, folder: str) -> DataFrame:
    """The value of each field with the highest support, by truth discovery over all claims of all groups."""
    return truth_discovery(_claims(spark, folder))[0].withColumn("support", F.round("support", 6))


def p1_reliability(spark: SparkSession, folder: str) -> DataFrame:
    """What truth discovery thinks of each source."""
    return truth_discovery(_claims(spark, folder))[1].withColumn("reliability", F.round("reliability", 4))


QUERIES = {"p1_found": p1_found, "p1_truth": p1_truth, "p1_reliability": p1_reliability}

_ABSENT = "({0} IS NULL OR lower(trim({0}, ' \t\n\r')) IN ('', 'n/a', 'unknown', 'tbd', '-', 'none'))"
_FIRST = "SELECT group_id, '{0}' AS field_name, id AS from_id FROM ranked WHERE {1} QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY {2}) = 1"
_ORDER = "trust, score DESC, seen NULLS LAST, id"

SQL = {
    "p1_found": f"""
WITH reg AS (SELECT lower(trim(source_name)) AS n, min(trust_rank) AS r FROM source_registry GROUP BY 1),
trust AS (SELECT c.id, min(reg.r) AS trust FROM companies c, unnest(CAST(try_cast(c.source_ids AS JSON) AS VARCHAR[])) AS u(s)
          JOIN reg ON reg.n = lower(trim(u.s)) GROUP BY 1),
typed AS (SELECT c.*, lower(trim(canonical_id)) AS gid, coalesce(t.trust, 2147483647) AS trust,
          CASE WHEN venture_scale_score BETWEEN 0 AND 10 AND NOT isnan(venture_scale_score) THEN venture_scale_score END AS s,
          CASE WHEN regexp_full_match(trim(first_seen_at), '[0-9]+') THEN to_timestamp(CAST(trim(first_seen_at) AS BIGINT))
               ELSE try_cast(CASE WHEN regexp_matches(trim(first_seen_at), '(Z|[+-][0-9][0-9]:?[0-9][0-9])$') THEN trim(first_seen_at)
                                  ELSE trim(first_seen_at) || '+00' END AS TIMESTAMPTZ) END AS seen
          FROM companies c LEFT JOIN trust t ON t.id = c.id),
members AS (SELECT gid AS group_id, typed.* FROM typed WHERE gid <> ''
            UNION SELECT id AS group_id, typed.* FROM typed WHERE id IN (SELECT gid FROM typed WHERE gid <> '')),
ranked AS (SELECT *, coalesce(s, 0) AS score FROM members QUALIFY count(*) OVER (PARTITION BY group_id) > 1)
{_FIRST.format("record", "true", _ORDER)}
UNION ALL {_FIRST.format("canonical_domain", f"NOT {_ABSENT.format('canonical_domain')}", _ORDER)}
UNION ALL {_FIRST.format("website", f"NOT {_ABSENT.format('website')}", _ORDER)}
UNION ALL {_FIRST.format("summary", f"NOT {_ABSENT.format('summary')}", _ORDER)}
UNION ALL {_FIRST.format("venture_scale_score", "s IS NOT NULL", _ORDER)}
UNION ALL {_FIRST.format("first_seen_at", "seen IS NOT NULL", "seen, id")}
"""
}
