"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, oracle_connection
from helpers import SF_DIR

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], SQL.get(name), SF_DIR) == ""


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
