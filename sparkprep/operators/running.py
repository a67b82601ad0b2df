"""Fitted state that is kept by load and merged, so that a new load never rescans the old ones.

A state is a small table that a load's records give by one aggregate; the states of all loads merge
into that of all records. Each load writes its own part, and writing it again replaces it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions import column
from sparkprep.operators.categories import category_text
from sparkprep.operators.numeric import known
from sparkprep.operators.profile import percent

LOAD = "load"
SKETCH_BITS = 14
"""The distinct sketch has two to this many buckets: a relative deviation of some 0.8%."""


def record(state: DataFrame, path: str, load: str) -> None:
    """Write the state of one load; other loads' parts stay."""
    (
        state.withColumn(LOAD, F.lit(load))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD)
        .parquet(path)
    )


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """The states of all loads."""
    return spark.read.parquet(path).drop(LOAD)


def merge_counts(states: DataFrame) -> DataFrame:
    """Category counts of all loads, as one :func:`category_counts` of all records gives them.

    Modes, frequencies and index labels follow from these as from any counts.
    """
    return states.groupBy("column", "category").agg(F.sum("n").alias("n"))


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n, mean, m2)``: known values, their mean and their summed squared deviation."""
    parts = []
    for i, name in enumerate(columns):
        value = known(name)
        n = F.count(value)
        parts += [n.alias(f"n_{i}"), F.avg(value).alias(f"mean_{i}"), (F.var_pop(value) * n).alias(f"m2_{i}")]
    entries = F.array(
        *(
            F.struct(F.lit(c).alias("column"), *(F.col(f"{f}_{i}").alias(f) for f in ("n", "mean", "m2")))
            for i, c in enumerate(columns)
        )
    )
    return df.agg(*parts).select(F.inline(entries))


def merge_moments(states: DataFrame) -> DataFrame:
    """``(column, n, mean, m2, deviation)`` of all loads; ``deviation`` is the sample deviation.

    Deviations are taken from the common mean: a load adds its own squared deviations and those of its
    mean, so large means lose no digits as they would in sums of squares. A column without values has
    NULLs, with one value it has no deviation.
    """
    some = F.col("n") > 0
    whole = states.groupBy("column").agg(
        F.sum("n").alias("_n"), F.try_divide(F.sum(F.when(some, F.col("n") * F.col("mean"))), F.sum("n")).alias("_mean")
    )
    apart = F.col("mean") - F.col("_mean")
    return (
        states.join(F.broadcast(whole), "column")  # one row a column
        .groupBy("column")
        .agg(
            F.max("_n").alias("n"),
            F.max("_mean").alias("mean"),
            F.sum(F.when(some, F.col("m2") + F.col("n") * apart * apart)).alias("m2"),
        )
        .withColumn("deviation", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))))
    )


def distinct_state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, sketch, missing_row, total_row)``: a distinct-count sketch of fixed size a column."""
    names, parts = list(columns or df.columns), [F.count(F.lit(1)).alias("_total")]
    for i, name in enumerate(names):
        parts.append(F.hll_sketch_agg(category_text(df, name), SKETCH_BITS).alias(f"sketch_{i}"))
        parts.append(F.count_if(column(name).isNull()).alias(f"missing_{i}"))
    entries = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"sketch_{i}").alias("sketch"),
                F.col(f"missing_{i}").alias("missing_row"),
                F.col("_total").alias("total_row"),
            )
            for i, c in enumerate(names)
        )
    )
    return df.agg(*parts).select(F.inline(entries))


def merge_distinct(states: DataFrame) -> DataFrame:
    """The unique profile of all loads; NULL counts as one distinct value.

    ``(column, n_unique, missing_row, missing_percentage)``, with ``n_unique`` an estimate.
    """
    merged = states.groupBy("column").agg(
        F.hll_union_agg("sketch").alias("sketch"),
        F.sum("missing_row").alias("missing_row"),
        F.sum("total_row").alias("total_row"),
    )
    null = (F.col("missing_row") > 0).cast("long")
    return merged.select(
        "column",
        (F.hll_sketch_estimate("sketch") + null).alias("n_unique"),
        "missing_row",
        percent(F.col("missing_row"), F.col("total_row")).alias("missing_percentage"),
    )


