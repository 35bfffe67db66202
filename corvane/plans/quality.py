"""Problem 6: profile of the run statistics and the run audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators.profile import Profile, TableSpec, find_issues, is_uuid, real_date, real_time
from corvane.plans.common import table

TOP = 50_000


def _outside(c: str):
    return ~F.col(c).between(0, TOP)


def _stats(spark: SparkSession, folder: str) -> Profile:
    checks = {
        "total_records": _outside("total_records"),
        "venture_scale": _outside("venture_scale") | (F.col("total_records").between(0, TOP) & (F.col("venture_scale") > F.col("total_records"))),
        "pass_rate": F.isnan("pass_rate") | ~F.col("pass_rate").between(0, 1),
    }
    confirm = {"run_date": ~real_date("run_date"), "run_id": ~is_uuid("run_id"), "source_name": F.lit(False)}
    numbers = ["total_records", "hard_excluded", "not_venture_scale", "borderline", "venture_scale", "manually_promoted", "manually_demoted", "pass_rate", "false_positive_rate", "false_negative_rate"]
    texts = ["run_id", "source_name", "run_date"]
    spec = TableSpec("source_run_stats", "load_no", "id", texts + numbers, checks, numbers, texts, confirm=confirm, meaning={"run_date": ~real_date("run_date")})
    return Profile(table(spark, folder, "source_run_stats"), spec)


def _runs(spark: SparkSession, folder: str) -> Profile:
    confirm = {"run_id": ~is_uuid("run_id"), "started_at": ~real_time("started_at"), "completed_at": ~real_time("completed_at"), "source": F.lit(False), "error": F.lit(False)}
    meaning = {
        "started_at": ~real_time("started_at"),
        "completed_at": ~real_time("completed_at") | (real_time("started_at") & (F.col("completed_at") < F.col("started_at"))),
    }
    texts = ["run_id", "source", "started_at", "completed_at", "error"]
    spec = TableSpec("harvest_runs", "load_no", "id", [*texts, "success", "records_harvested"], {"records_harvested": _outside("records_harvested")}, ["success", "records_harvested"], texts, confirm=confirm, meaning=meaning)
    return Profile(table(spark, folder, "harvest_runs"), spec)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Offending cells and odd loads of both tables, over all rows."""
    a = find_issues(_stats(spark, folder), nulls=["total_records", "venture_scale", "pass_rate"], shift=["total_records", "venture_scale", "pass_rate"], distinct=["source_name"])
    b = find_issues(_runs(spark, folder), nulls=["records_harvested", "completed_at"], shift=["records_harvested"], distinct=["source"])
    return a.unionByName(b)


def p6_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile of every column in every load of both tables."""
    return _stats(spark, folder).loads.unionByName(_runs(spark, folder).loads)


def p6_expressions(spark: SparkSession, folder: str) -> DataFrame:
    """The induced expressions of every text column and how many rows of each load they cover."""
    return _stats(spark, folder).expressions_by_load().unionByName(_runs(spark, folder).expressions_by_load())


QUERIES = {"p6_found": p6_found, "p6_profile": p6_profile, "p6_expressions": p6_expressions}

_UUID = "'[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}'"
_TIME = "(regexp_full_match({0}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}Z') AND try_strptime({0}, '%Y-%m-%dT%H:%M:%SZ') IS NOT NULL)"
_CHECKS = {
    "source_run_stats": {
        "total_records": "total_records NOT BETWEEN 0 AND 50000",
        "venture_scale": "venture_scale NOT BETWEEN 0 AND 50000 OR (total_records BETWEEN 0 AND 50000 AND venture_scale > total_records)",
        "pass_rate": "isnan(pass_rate) OR pass_rate NOT BETWEEN 0 AND 1",
        "run_date": "NOT (regexp_full_match(run_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_strptime(run_date, '%Y-%m-%d') IS NOT NULL)",
        "run_id": f"NOT regexp_full_match(run_id, {_UUID})",
    },
    "harvest_runs": {
        "records_harvested": "records_harvested NOT BETWEEN 0 AND 50000",
        "run_id": f"NOT regexp_full_match(run_id, {_UUID})",
        "started_at": f"NOT {_TIME.format('started_at')}",
        "completed_at": f"NOT {_TIME.format('completed_at')} OR ({_TIME.format('started_at')} AND completed_at < started_at)",
    },
}
_NULLS = {"source_run_stats": ["total_records", "venture_scale", "pass_rate"], "harvest_runs": ["records_harvested", "completed_at"]}
_SHIFT = {"source_run_stats": ["total_records", "venture_scale", "pass_rate"], "harvest_runs": ["records_harvested"]}
_DISTINCT = {"source_run_stats": "source_name", "harvest_runs": "source"}


def _found_sql() -> str:
    parts = []
    for t, checks in _CHECKS.items():
        for c, bad in checks.items():
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'cell' AS issue, CAST(id AS BIGINT) AS case_key FROM {t} WHERE {c} IS NOT NULL AND ({bad})")
        for c in _NULLS[t]:
            parts.append(f"SELECT '{t}', '{c}', 'nulls', CAST(load_no AS BIGINT) FROM (SELECT load_no, s, median(s) OVER () AS m FROM (SELECT load_no, count(*) FILTER ({c} IS NULL) / count(*) AS s FROM {t} WHERE load_no IS NOT NULL GROUP BY load_no)) WHERE s - m >= 0.155")
        for c in _SHIFT[t]:
            parts.append(f"SELECT '{t}', '{c}', 'shift', CAST(load_no AS BIGINT) FROM (SELECT load_no, s, median(s) OVER () AS m FROM (SELECT load_no, median(CAST({c} AS DOUBLE)) AS s FROM {t} WHERE load_no IS NOT NULL AND {c} IS NOT NULL AND NOT coalesce({checks[c]}, false) GROUP BY load_no)) WHERE m > 0 AND (s >= 3 * m OR 3 * s <= m)")
        c = _DISTINCT[t]
        parts.append(f"SELECT '{t}', '{c}', 'distinct', CAST(load_no AS BIGINT) FROM (SELECT load_no, s, median(s) OVER () AS m FROM (SELECT load_no, count(DISTINCT {c}) AS s FROM {t} WHERE load_no IS NOT NULL GROUP BY load_no)) WHERE 2 * s <= m")
    return "\nUNION ALL\n".join(parts)


SQL = {"p6_found": _found_sql()}
