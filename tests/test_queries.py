"""Every named query against its SQL on the smallest tables."""

import pytest
from check import compare, connect

import __spark_entry__ as entry_point
from querybook import QUERIES, SQL


@pytest.fixture(scope="module")
def duck():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf, name):
    assert name in SQL
    assert compare(duck, QUERIES[name](spark, sf), SQL[name]) is None


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    assert set(entry_point.queries()) >= set(entry_point.oracle_sql()) >= set(SQL)
