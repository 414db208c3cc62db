"""Every registered query against its SQL on the smallest test set."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry.library_queries(), entry.library_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLE) <= set(QUERIES)
    assert sorted(set(QUERIES) - set(ORACLE)) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    ok, note = compare(spark, QUERIES[name], ORACLE.get(name), SF_DIR, connection)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
