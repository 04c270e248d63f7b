"""Every named query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, tables, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(df.collect()) > 0
    else:
        assert compare(df, tables, sql) is None


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["pair_id", "label", "ids", "segments"]
