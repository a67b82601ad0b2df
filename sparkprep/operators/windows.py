"""Load windows over a date range, and the rows that fall into them.

All windows are half-open: a row at an upper bound belongs to the next window, or the next run.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions import column
from sparkprep.workspace import discard

# A span of more than so many days is cut into units of this length.
GRANULARITIES = ((365, "year"), (30, "month"), (7, "week"))
SINGLE = "single"


def granularity(first: Column, last: Column) -> Column:
    """Window length for a span: year, month, week, or ``single`` for one window."""
    days = F.datediff(last, first)
    unit = F.lit(SINGLE)
    for limit, name in reversed(GRANULARITIES):
        unit = F.when(days > limit, F.lit(name)).otherwise(unit)
    return unit


def span(df: DataFrame, ts: str) -> DataFrame:
    """One row ``(from_date, to_date)`` with ``to_date`` the day after the last row."""
    return df.agg(
        F.min(column(ts)).cast("date").alias("from_date"),
        F.date_add(F.max(column(ts)).cast("date"), 1).alias("to_date"),
    )


def plan_windows(bounds: DataFrame) -> DataFrame:
    """``(granularity, from_date, to_date)`` windows that tile ``bounds`` exactly.

    Windows begin at ``from_date`` and follow calendar units from there on. ``bounds`` holds one
    row; equal bounds give no window.
    """
    bounds = bounds.where(F.col("from_date") < F.col("to_date")).withColumn(
        "granularity", granularity(F.col("from_date"), F.col("to_date"))
    )
    starts = F.lit(None)
    for _, unit in reversed(GRANULARITIES):
        aligned = F.sequence(
            F.trunc("from_date", unit), F.date_sub("to_date", 1), F.expr(f"interval 1 {unit}")
        )
        starts = F.when(F.col("granularity") == unit, aligned).otherwise(starts)
    starts = F.coalesce(starts, F.array("from_date"))
    return bounds.select(
        "granularity", "from_date", "to_date", F.posexplode(starts).alias("_i", "_start"), starts.alias("_all")
    ).select(
        "granularity",
        F.greatest("_start", "from_date").alias("from_date"),
        F.coalesce(F.get("_all", F.col("_i") + 1), F.col("to_date")).alias("to_date"),
    )


def window_start(ts: Column, first: date, unit: str) -> Column:
    """Start of the window that holds ``ts``: an expression, so rows need no join to find it."""
    if unit == SINGLE:
        return F.lit(first)
    return F.greatest(F.trunc(ts.cast("date"), unit), F.lit(first))


def window_counts(df: DataFrame, ts: str) -> DataFrame:
    """Rows of each window over the table's own span, empty windows included.

    Rows without a time are in no window.
    """
    bounds = span(df, ts).first()
    spark = df.sparkSession
    if bounds["from_date"] is None:
        return spark.createDataFrame([], "from_date date, to_date date, n long")
    windows = plan_windows(fixed_span(spark, bounds["from_date"], bounds["to_date"]))
    unit = windows.first()["granularity"]
    dated = df.where(column(ts).isNotNull())
    counted = dated.groupBy(window_start(column(ts), bounds["from_date"], unit).alias("from_date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return windows.join(counted, "from_date", "left").select(
        "from_date", "to_date", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )


WINDOW = "window_from"


def write_windows(df: DataFrame, ts: str, path: str, first: date, unit: str) -> None:
    """Write the records of each window to a part of its own, in place of what was there before.

    Only windows that ``df`` has records of are replaced, so a window can be extracted again, and a
    load that is repeated adds nothing. Records without a time are in no window. Large windows are split
    between tasks and small ones share one.
    """
    dated = df.where(column(ts).isNotNull())
    (
        dated.withColumn(WINDOW, window_start(column(ts), first, unit))
        .hint("rebalance", WINDOW)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(WINDOW)
        .parquet(path)
    )


def rewrite_window(df: DataFrame, ts: str, path: str, window: tuple[date, date], first: date, unit: str) -> None:
    """Extract one window ``(from_date, to_date)`` again; a window without records is emptied."""
    records = time_slice(df, ts, *window)
    if records.isEmpty():
        discard(df.sparkSession, f"{path}/{WINDOW}={window[0].isoformat()}")
    else:
        write_windows(records, ts, path, first, unit)


def fixed_span(spark: SparkSession, first: date, last: date) -> DataFrame:
    return spark.createDataFrame([(first, last)], "from_date date, to_date date")


def resolve_span(
    from_date: date,
    to_date: date | None = None,
    min_start: date | None = None,
    watermark: date | None = None,
) -> tuple[date, date]:
    """Range of the next load.

    ``from_date`` is raised to ``min_start``, unless a watermark exists, which then takes its place
    whatever ``min_start`` says. ``to_date`` defaults to today. Equal bounds mean no work.
    """
    first = max(from_date, min_start) if min_start else from_date
    if watermark is not None:
        first = watermark
    return first, to_date or date.today()


def time_slice(df: DataFrame, ts: str, first: date, last: date) -> DataFrame:
    """Rows from ``first`` up to but not including ``last``; the bounds reach the parquet scan."""
    kind = df.schema[ts].dataType.typeName()
    return df.where((column(ts) >= _bound(first, kind)) & (column(ts) < _bound(last, kind)))


def _bound(day: date, kind: str) -> Column:
    if kind == "date":
        return F.lit(day)
    moment = datetime(day.year, day.month, day.day)
    return F.lit(moment.isoformat(sep=" ")).cast(kind)
