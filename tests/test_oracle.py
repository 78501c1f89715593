"""Every registered query against DuckDB on the same tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference
from entry_queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None


@needs_tables
def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())
