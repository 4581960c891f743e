"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from compare import differences, oracle, oracle_rows, spark_rows
from conftest import SMALL

import __spark_entry__ as contract

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle(SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = spark_rows(QUERIES[name](spark, SMALL))
    assert got[1], "no rows"
    if name in ORACLE:
        assert differences(got, oracle_rows(con, ORACLE[name])) == []


def test_entry(spark):
    assert contract.entry(spark).columns == contract.entry(spark).columns
