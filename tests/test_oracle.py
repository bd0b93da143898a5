"""Every registered query against its SQL in DuckDB, values compared exactly."""

import pytest
from compare import connect, differences

import __spark_entry__ as driver
from tallyhouse.plans.oracle import ORACLE
from tallyhouse.plans.registry import QUERIES


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, small, connection, name):
    result = driver.queries()[name](spark, small)
    assert differences(result, connection, driver.oracle_sql()[name]) == []
    assert driver.queries()[name] is QUERIES[name]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert driver.entry(spark).count() == 80
