"""Every query of the core against its SQL; those without SQL must run."""

import pytest

from quillwort.plans import catalog
from tests.helpers import rows_of, rows_of_sql

QUERIES, SQL = catalog.queries(), catalog.sql()


def test_sql_has_only_known_names():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    columns, rows = rows_of(QUERIES[name](spark, sf))
    if name in SQL:
        assert (columns, rows) == rows_of_sql(SQL[name], sf)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
