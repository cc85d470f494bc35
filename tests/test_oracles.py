"""Every registered query against its SQL over the whole small tables."""

import __spark_entry__ as entry
import compare
import pytest
from conftest import SMALL

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.database(SMALL)


def test_each_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, connection, name):
    assert compare.difference(QUERIES[name](spark, SMALL), connection, SQL[name]) is None


def test_entry_has_rows(spark):
    assert {r.is_late for r in entry.entry(spark).collect()} == {True, False}
