from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkprep.operators import windows as w
from sparkprep.sources.tables import table

SF_DIR = "/root/testdata/sf0.001"


def planned(spark, first, last):
    rows = w.plan_windows(w.fixed_span(spark, first, last)).orderBy("from_date").collect()
    return [(r["granularity"], r["from_date"], r["to_date"]) for r in rows]


@pytest.mark.parametrize(
    "days, unit", [(7, "single"), (8, "week"), (30, "week"), (31, "month"), (365, "month"), (366, "year")]
)
def test_granularity_limits(spark, days, unit):
    first = date(2023, 5, 3)
    assert planned(spark, first, first + timedelta(days=days))[0][0] == unit


def test_first_window_starts_at_from_date(spark):
    found = planned(spark, date(2023, 5, 1), date(2023, 8, 12))
    assert [(a, b) for _, a, b in found] == [
        (date(2023, 5, 1), date(2023, 6, 1)),
        (date(2023, 6, 1), date(2023, 7, 1)),
        (date(2023, 7, 1), date(2023, 8, 1)),
        (date(2023, 8, 1), date(2023, 8, 12)),
    ]


def test_equal_bounds_give_no_window(spark):
    assert planned(spark, date(2023, 5, 1), date(2023, 5, 1)) == []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(start=st.dates(date(2000, 1, 1), date(2030, 1, 1)), days=st.integers(1, 1500))
def test_windows_tile_the_span(spark, start, days):
    end = start + timedelta(days=days)
    found = planned(spark, start, end)
    assert found[0][1] == start and found[-1][2] == end
    assert all(a < b for _, a, b in found)
    assert all(x[2] == y[1] for x, y in zip(found, found[1:]))


def test_counts_include_empty_windows(spark):
    df = spark.createDataFrame([(date(2023, 1, 5),), (date(2023, 4, 2),)], "d date")
    found = [(r["from_date"], r["n"]) for r in w.window_counts(df, "d").orderBy("from_date").collect()]
    assert found == [
        (date(2023, 1, 5), 1),
        (date(2023, 2, 1), 0),
        (date(2023, 3, 1), 0),
        (date(2023, 4, 1), 1),
    ]


def test_rows_without_a_time_are_in_no_window(spark):
    days = [date(2023, 1, d) for d in range(1, 5)] + [None] * 3
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r["n"] for r in w.window_counts(df, "d").collect()] == [4]
    long = spark.createDataFrame([(date(2023, m, 1),) for m in range(1, 5)] + [(None,)], "d date")
    assert [r["n"] for r in w.window_counts(long, "d").collect()] == [1, 1, 1, 1]


def test_counts_of_nothing(spark):
    assert w.window_counts(spark.createDataFrame([], "d date"), "d").count() == 0


def test_resolve_span():
    early, low, high = date(2020, 1, 1), date(2023, 5, 1), date(2023, 8, 1)
    assert w.resolve_span(early, high, low) == (low, high)
    assert w.resolve_span(high, high, low) == (high, high)
    assert w.resolve_span(early, high, low, watermark=early) == (early, high)
    assert w.resolve_span(low)[1] == date.today()


def test_slice_is_half_open(spark):
    days = [date(2023, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r["d"] for r in w.time_slice(df, "d", days[0], days[2]).collect()] == days[:2]


def test_slice_reaches_the_scan(spark):
    df = w.time_slice(table(spark, SF_DIR, "orders"), "o_orderdate", date(1997, 1, 1), date(1998, 1, 1))
    plan = df.select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_finding_a_row_s_window_needs_no_join(spark):
    df = table(spark, SF_DIR, "orders")
    start = w.window_start(F.col("o_orderdate"), date(1992, 3, 5), "month")
    assert "Join" not in df.select(start)._jdf.queryExecution().executedPlan().toString()
