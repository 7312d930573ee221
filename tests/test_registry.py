"""Every registered query against its SQL on the given tables."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as spark_entry  # noqa: E402

QUERIES, SQL = spark_entry.queries(), spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(shown(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    got = result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in SQL:
        assert got
        return
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert rows(result.columns, got) == rows(columns, cursor.fetchall())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
