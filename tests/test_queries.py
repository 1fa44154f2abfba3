import os

import pytest

import __spark_entry__ as contract
from tests.compare import compare, oracle_connection

FOLDER = os.environ.get("LAKEMILL_TEST_SF", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name, QUERIES, ORACLES)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_a_twin_runs(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
