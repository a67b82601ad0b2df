"""Column expressions: names, dates, key digests and text."""

from sparkprep.functions.columns import column
from sparkprep.functions.dates import as_timestamp, day_difference
from sparkprep.functions.digests import DIGEST_BUCKETS, digest_bucket, key_digest
from sparkprep.functions.text import tokens
from sparkprep.functions.vectors import stored_entries

__all__ = [
    "DIGEST_BUCKETS",
    "as_timestamp",
    "column",
    "day_difference",
    "digest_bucket",
    "key_digest",
    "stored_entries",
    "tokens",
]
