"""Every registered query against its SQL, on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from workload import QUERIES

TABLES = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    df = contract.queries()[name](spark, str(TABLES))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = database.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=repr)
    assert got == wanted


def test_entry(spark):
    assert contract.entry(spark).count() > 0
