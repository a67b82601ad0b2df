"""Word splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\x0b\f\r"


def tokens(text: Column) -> Column:
    """Lower-cased words between single whitespace characters.

    Leading and inner empty words stay, trailing ones go, and an empty text gives one empty word,
    as ``pyspark.ml.feature.Tokenizer`` has it. NULL counts as the empty text.
    """
    given = F.coalesce(text, F.lit(""))
    trimmed = F.rtrim(given, F.lit(WHITESPACE))
    only_space = (trimmed == "") & (given != "")
    words = F.split(F.lower(trimmed), f"[{WHITESPACE}]")
    return F.when(only_space, F.array().cast("array<string>")).otherwise(words)
