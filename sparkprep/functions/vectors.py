from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkprep.functions.columns import column


def stored_entries(vector: str) -> Column:
    """``(position, value)`` structs of what an ML vector stores: all of a dense one, in order.

    A sparse vector is never spread to its full width.
    """
    parts = F.unwrap_udt(column(vector))
    indices = F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - 1))
    return F.zip_with(
        indices, parts["values"], lambda i, v: F.struct(i.alias("position"), v.alias("value"))
    )
