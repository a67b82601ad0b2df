"""Accepting, rejecting and requiring columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions import column
from sparkprep.operators.profile import high_missing, missing_report


class MissingColumnsError(ValueError):
    def __init__(self, missing: list[str], present: list[str]):
        super().__init__(f"required columns missing: {missing}; columns present: {present}")
        self.missing = missing


def columns_to_reject(
    df: DataFrame, unwanted: Iterable[str] = (), threshold: float = 0.4
) -> dict[str, str]:
    """Column names to drop, each with its reason; names the table lacks are left out.

    Only one report row per column reaches the driver.
    """
    wanted_out = set(unwanted)
    reasons = {c: "unwanted column" for c in df.columns if c in wanted_out}
    for row in high_missing(missing_report(df), threshold).collect():
        reasons.setdefault(row["column"], "contains many missing values")
    return {c: reasons[c] for c in df.columns if c in reasons}


def rejected_columns(df: DataFrame, reasons: dict[str, str], key: str | None = None) -> DataFrame:
    """The rejected columns with the row key and one message naming each column and its reason."""
    names = [c for c in df.columns if c in reasons or c == key]
    message = "; ".join(f"{c}: {why}" for c, why in reasons.items())
    return df.select(*(column(c) for c in names), F.lit(message).alias("error_msg"))


def accepted_columns(df: DataFrame, reasons: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Everything but the rejected columns; ``keep`` names columns to hold on to regardless."""
    held = set(keep)
    return df.drop(*(c for c in reasons if c not in held))


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(missing, df.columns)
    return df


def labelled(df: DataFrame, target: str) -> DataFrame:
    """Rows whose label is known."""
    return df.where(column(target).isNotNull())
