"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from tests.harness import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    _, difference = compare(QUERIES[name](spark, SF), duck, ORACLES[name])
    assert difference is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
