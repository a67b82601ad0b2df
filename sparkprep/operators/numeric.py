"""Filling and scaling of numeric columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions import column


def known(name: str) -> Column:
    """The column as a double with NaN turned to NULL."""
    value = column(name).cast("double")
    return F.when(~F.isnan(value), value)


def fit_means(df: DataFrame, columns: list[str], default: float | None = None) -> dict[str, float]:
    """Mean of each column over its non-NULL, non-NaN values, all in one scan."""
    row = df.agg(*(F.avg(known(c)).alias(str(i)) for i, c in enumerate(columns))).first()
    means = {c: default if row[str(i)] is None else row[str(i)] for i, c in enumerate(columns)}
    empty = [c for c, value in means.items() if value is None]
    if empty:
        raise ValueError(f"no values to average in {empty}; pass a default")
    return means


def _mean_or_fail(name: str, default: float | None) -> Column:
    """The mean, or the default of a column without values; without a default the query fails."""
    message = F.lit(f"no values to average in [{name!r}]; pass a default")
    otherwise = F.raise_error(message).cast("double") if default is None else F.lit(float(default))
    return F.when(F.count(known(name)) > 0, F.avg(known(name))).otherwise(otherwise)


def impute_means(df: DataFrame, outputs: dict[str, str], default: float | None = None) -> DataFrame:
    """Copy columns to their output names with NULL and NaN replaced by the column's mean.

    The means are scalar subqueries: Spark merges them into one aggregate, and the whole stays one
    lazy plan. A column of rows that are all missing has no mean: ``default`` stands in for it, or
    the query fails as :func:`fit_means` does. A table without rows needs none.
    """
    return df.withColumns(
        {
            out: F.coalesce(known(c), df.agg(_mean_or_fail(c, default)).scalar())
            for c, out in outputs.items()
        }
    )


def scale_by_deviation(df: DataFrame, outputs: dict[str, str]) -> DataFrame:
    """Divide columns by their sample standard deviation, uncentred; a constant column gives 0."""

    def scaled(name: str) -> Column:
        deviation = df.agg(F.stddev_samp(column(name))).scalar()
        value = F.coalesce(F.try_divide(column(name), deviation), F.lit(0.0))
        return F.when(column(name).isNotNull(), value)

    return df.withColumns({out: scaled(c) for c, out in outputs.items()})
