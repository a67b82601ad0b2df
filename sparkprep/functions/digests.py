"""Reproducible pseudo-random order of rows, taken from the MD5 digest of their key.

The order depends on the key alone, not on partitioning, so splits, samples and shuffles come out
the same on any cluster, and any engine with MD5 can repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkprep.functions.columns import column

# Digests are near uniform, so their first 16 bits cut any table of distinct keys into this many
# even slices, in digest order.
DIGEST_BUCKETS = 65536


def key_digest(key: str, salt: str = "") -> Column:
    """Hex digest of ``salt`` followed by the key; a NULL key counts as the empty string."""
    text = F.coalesce(column(key).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(salt), text) if salt else text)


def digest_bucket(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")
