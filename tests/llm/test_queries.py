"""Every query of the subpackage runs; those with SQL equal it."""

import pytest

from quillwort.llm.queries import QUERIES, SQL
from tests.helpers import rows_of, rows_of_sql


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    columns, rows = rows_of(QUERIES[name](spark, sf))
    if name in SQL:
        assert (columns, rows) == rows_of_sql(SQL[name], sf)
    wanted = {"p1_found": ["group_key"], "p2_found": ["source"], "p5_found": ["image_id", "matched_id"], "p6_found": ["record_id_a", "record_id_b"], "p7_ids": ["doc_id", "ids"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id"]}
    assert wanted.get(name, columns) == columns


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(__file__).resolve().parents[2] / "quillwort"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "quillwort.llm" not in path.read_text()
