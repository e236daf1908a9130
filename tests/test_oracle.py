"""Every registered query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

ROOT = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, ROOT), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
