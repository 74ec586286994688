"""Every registered query with an SQL twin, compared with DuckDB on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare, connect

from tideline.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    actual = QUERIES[name](spark, SF).toPandas()
    problem = compare(actual, duck.execute(ORACLES[name]).df())
    assert not problem, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_with_a_stable_schema(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() > 0
