"""Every query over the smallest tables, against its SQL."""

import pytest

import __spark_entry__ as contract
from lapwise.queries import collect
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, SQL = collect()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    difference, _ = compare(spark, con, QUERIES[name], SQL[name], SF)
    assert difference is None


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
