"""Every registered query with SQL gives DuckDB's rows."""

import pytest

from freshet import queries
from tests.harness import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_rows_equal(spark, name):
    assert compare(spark, name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF) == []


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.ORACLE_SQL)


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(queries.QUERIES) <= set(e.queries())
