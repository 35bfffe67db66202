"""The package's problems on empty and awkward tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
from edges import awkward, empty  # noqa: E402

from corvane.llm.queries import QUERIES  # noqa: E402

#: The report has a row for each target, and there are no targets.
FOUND = [q for q in QUERIES if q.endswith("_found")]


@pytest.mark.parametrize("name", QUERIES)
def test_empty(spark, data, tmp_path, name):
    assert QUERIES[name](spark, empty(spark, data, str(tmp_path))).count() == 0


@pytest.mark.parametrize("name", FOUND)
def test_awkward(spark, data, tmp_path, name):
    want = {tuple(r) for r in QUERIES[name](spark, data).collect()}
    got = {tuple(r) for r in QUERIES[name](spark, awkward(spark, data, str(tmp_path))).collect()}
    assert got == want


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in FOUND])
def test_others_run_on_awkward_tables(spark, data, tmp_path, name):
    assert QUERIES[name](spark, awkward(spark, data, str(tmp_path))).count() > 0 or name == "p7_reparam"
