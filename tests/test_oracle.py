"""Every registered query against its SQL counterpart on the driver's tables."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from workload.oracle import SQL
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(spark, con, name, sf_dir) is None


def test_entry(spark):
    got = contract.entry(spark)
    assert "VALID_FROM_TS" in got.columns and got.count() > 0
