"""Column profiles: one aggregate per table, not one job per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions import column
from sparkprep.operators.categories import category_counts


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; NULL when ``whole`` is zero."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns")
    )


def missing_report(df: DataFrame) -> DataFrame:
    """``(column, total_row, missing_row, missing_percentage)`` from a single scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count_if(column(c).isNull()).alias(f"missing_{i}") for i, c in enumerate(df.columns)),
    )
    entries = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(f"missing_{i}").alias("missing_row"))
            for i, c in enumerate(df.columns)
        )
    )
    return counts.select(F.col("total").alias("total_row"), F.inline(entries)).select(
        "column",
        "total_row",
        "missing_row",
        percent(F.col("missing_row"), F.col("total_row")).alias("missing_percentage"),
    )


def high_missing(report: DataFrame, threshold: float = 0.4) -> DataFrame:
    """Columns missing in strictly more than ``threshold`` of the rows."""
    return report.where(F.col("missing_percentage") > F.lit(threshold * 100.0))


def unique_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact distinct and missing counts per column; NULL counts as one distinct value.

    Values are counted before they are grouped by column, so equal values meet as partial counts
    and no task holds a column's values.
    """
    names = list(columns or df.columns)
    found = (
        category_counts(df, names)
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("n_unique"),
            F.sum("n").alias("total_row"),
            F.sum(F.when(F.col("category").isNull(), F.col("n")).otherwise(0)).alias("missing_row"),
        )
    )
    every = df.sparkSession.createDataFrame([(c,) for c in names], "column string")
    zero = F.lit(0).cast("long")
    return every.join(found, "column", "left").select(
        "column",
        F.coalesce("n_unique", zero).alias("n_unique"),
        F.coalesce("missing_row", zero).alias("missing_row"),
        percent(F.col("missing_row"), F.col("total_row")).alias("missing_percentage"),
    )


def approx_unique_profile(df: DataFrame, rsd: float = 0.05) -> DataFrame:
    """As :func:`unique_profile` with HyperLogLog counts: one scan, a fixed-size state per column."""
    parts: list[Column] = [F.count(F.lit(1)).alias("total")]
    for i, name in enumerate(df.columns):
        missing = F.count_if(column(name).isNull())
        parts.append(missing.alias(f"missing_{i}"))
        parts.append(
            (F.approx_count_distinct(column(name), rsd) + (missing > 0).cast("long")).alias(
                f"unique_{i}"
            )
        )
    entries = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"unique_{i}").alias("n_unique"),
                F.col(f"missing_{i}").alias("missing_row"),
            )
            for i, c in enumerate(df.columns)
        )
    )
    return (
        df.agg(*parts)
        .select("total", F.inline(entries))
        .select(
            "column",
            "n_unique",
            "missing_row",
            percent(F.col("missing_row"), F.col("total")).alias("missing_percentage"),
        )
    )


def approx_within(df: DataFrame, rsd: float = 0.05, multiple: float = 4.0) -> DataFrame:
    """``(column, n_unique, missing_row, within)``: exact counts, and whether the estimate is near.

    Near is within ``multiple`` times ``rsd`` of the exact count, or one off it.
    """
    estimated = approx_unique_profile(df, rsd).select("column", F.col("n_unique").alias("estimate"))
    exact = unique_profile(df).select("column", "n_unique", "missing_row")
    allowed = F.greatest(F.lit(1.0), F.lit(multiple * rsd) * F.col("n_unique"))
    within = F.abs(F.col("estimate") - F.col("n_unique")) <= allowed
    return exact.join(estimated, "column").select("column", "n_unique", "missing_row", within.alias("within"))


def schema_table(df: DataFrame) -> DataFrame:
    """The schema as rows ``(position, name, type, nullable)``."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, nullable boolean"
    )
