"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.parity import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return connect(FOLDER)


def test_twins_belong_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, message = compare(spark, con, FOLDER, name, QUERIES[name], SQL.get(name))
    assert ok, message


def test_entry(spark):
    assert entry.entry(spark).count() > 0
