"""The core's problems on empty and awkward tables."""

import pytest
from edges import awkward, empty

from corvane.plans import quality, snapshots

QUERIES = {**snapshots.QUERIES, **quality.QUERIES}


@pytest.mark.parametrize("name", QUERIES)
def test_empty(spark, data, tmp_path, name):
    assert QUERIES[name](spark, empty(spark, data, str(tmp_path))).count() == 0


@pytest.mark.parametrize("name", ["p5_found", "p6_found"])
def test_awkward(spark, data, tmp_path, name):
    want = {tuple(r) for r in QUERIES[name](spark, data).collect()}
    got = {tuple(r) for r in QUERIES[name](spark, awkward(spark, data, str(tmp_path))).collect()}
    assert got == want
