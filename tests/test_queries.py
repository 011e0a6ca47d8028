"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert oracle.compare(df, con, sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 3
