"""Every registered query against its SQL twin on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_twins_belong_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, small, name):
    assert compare(QUERIES[name](spark, small), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
