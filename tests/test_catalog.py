"""Every registered query against its SQL counterpart, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import connect, differences

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    query, sql = contract.queries()[name], contract.oracle_sql().get(name)
    if sql is None:
        assert query(spark, SF).collect()
    else:
        assert differences(spark, con, name, query, sql, SF) is None


def test_oracles_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    out = contract.entry(spark)
    assert out.count() == 11 and "is_empty" in out.columns
