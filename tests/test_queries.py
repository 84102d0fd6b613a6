"""Every registered query beside its SQL, on the given tables."""

import os

import pytest

import __spark_entry__ as contract
from oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.columns and df.count() >= 0
        return
    assert compare(df, con, sql) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert "id" in df.columns and df.count() > 0
