"""Every registered query runs on the smallest tables and equals its SQL where it has one."""

import os

import pytest

import __spark_entry__ as entry
from suite import catalog
from suite.check import compare, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables are absent")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name in SQL:
        assert compare(got, con.execute(SQL[name]).df()) is None
    else:
        assert len(got) > 0 and not got.isna().any().any()


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
