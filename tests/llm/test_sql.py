"""The operators that SQL can express, against their SQL."""

import pytest

from lapwise.llm.queries import QUERIES
from oracle import compare, connect

SF = "/root/testdata/sf0.01"
SQL = {name: (query, sql) for name, (query, sql) in QUERIES.items() if sql is not None}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, con, name):
    difference, _ = compare(spark, con, *SQL[name], SF)
    assert difference is None
