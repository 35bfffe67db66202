"""Every query of the package: those with SQL give what it gives, the others run."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
from oracle import check  # noqa: E402

from corvane.llm.queries import QUERIES, SQL  # noqa: E402

COLUMNS = {
    "p1_found": ["group_id", "field_name", "from_id"], "p2_found": ["company_id", "raw_id"], "p3_found": ["company_id", "group_id"],
    "p4_found": ["entity_kind", "name_a", "name_b"], "p7_found": ["doc_id", "item_id"], "p9_found": ["doc_id"],
}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, data, name):
    if name in SQL:
        check(spark, data, QUERIES[name], SQL[name])
    df = QUERIES[name](spark, data)
    assert name not in COLUMNS or df.columns == COLUMNS[name]
    rows = [tuple(r) for r in df.collect()]
    assert not name.endswith("_found") or len(rows) == len(set(rows))
