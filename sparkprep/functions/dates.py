from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkprep.functions.columns import column

SECONDS_PER_DAY = 86400.0


def as_timestamp(name: str) -> Column:
    """Timestamp value of a text, date or timestamp column; malformed text becomes NULL."""
    return column(name).try_cast("timestamp")


def day_difference(start: str, end: str) -> Column:
    """Absolute difference of two timestamps in days, as a double."""
    seconds = F.unix_seconds(as_timestamp(end)) - F.unix_seconds(as_timestamp(start))
    return F.abs(seconds) / F.lit(SECONDS_PER_DAY)
