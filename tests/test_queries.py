"""Every registered query with SQL gives what its SQL gives."""

import os
import subprocess
import sys

import pytest
from oracle import check

import corvane.plans.functions_sql as functions_sql
import corvane.plans.passes_sql as passes_sql
import corvane.plans.quality as quality
import corvane.plans.relations_sql as relations_sql
import corvane.plans.scans_sql as scans_sql
import corvane.plans.snapshots as snapshots
import corvane.plans.stages_sql as stages_sql

MODULES = (snapshots, quality, functions_sql, relations_sql, scans_sql, stages_sql, passes_sql)
ALL = [(k, m) for m in MODULES for k in m.QUERIES]


@pytest.mark.parametrize("name,module", ALL, ids=[k for k, _ in ALL])
def test_query(spark, data, name, module):
    if name in module.SQL:
        check(spark, data, module.QUERIES[name], module.SQL[name])
    else:
        df = module.QUERIES[name](spark, data)
        rows = [tuple(r) for r in df.collect()]
        assert rows and df.columns and len(set(df.columns)) == len(df.columns)


def test_queries_can_be_listed_without_a_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[-1] == "True", out.stderr
