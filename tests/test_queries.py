"""Every registered query against its SQL on the test tables."""

import os

import pytest

import __spark_entry__ as contract
from lookback.plans.catalog import QUERIES
from lookback.plans.oracles import ORACLES
from oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_contract_serves_the_catalog():
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    only_spark, only_sql, got, want = compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR)
    assert got == want
    assert not only_spark and not only_sql


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
