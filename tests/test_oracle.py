"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    yield connection
    connection.close()


def check_plan(df):
    """No cross or nested-loop join, and no Python in the rows' way."""
    text = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    check_plan(found)
    names = sorted(found.columns)
    rows = Counter(tuple(r) for r in found.select(*names).collect())
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    order = [columns.index(c) for c in names]
    expected = Counter(tuple(r[i] for i in order) for r in cursor.fetchall())
    assert rows, "no rows"
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    check_plan(found)
    assert found.count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1500
