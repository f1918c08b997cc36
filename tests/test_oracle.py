"""Every registered query against DuckDB on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import compare, oracle_rows  # noqa: E402

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, sf_dir, duck, name):
    df = contract.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    names, expected = oracle_rows(duck, ORACLES[name])
    assert compare(df.columns, rows, names, expected) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 249
