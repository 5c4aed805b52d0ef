"""Every registered query against DuckDB on the smallest tables."""

import os

import pytest
from check import compare, connect

from opsgrain.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    assert name in ORACLE, "every query has a counterpart"
    assert compare(df, con, ORACLE[name]) is None


def test_driver_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
