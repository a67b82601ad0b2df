from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """Top-level column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")
