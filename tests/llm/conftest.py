from __future__ import annotations

import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "tu", "so") for b in ("ran", "vel", "dis", "por", "")]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from sparkprep.llm.common import ship

    ship(spark)


@pytest.fixture
def prose():
    """Invented sentences, the same for the same seed."""

    def make(n: int, seed: int, per_line: int = 15) -> str:
        rng = random.Random(seed)
        words = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]
        lines = [" ".join(words[k : k + per_line]) for k in range(0, n, per_line)]
        return "\n".join(lines)

    return make


@pytest.fixture
def table(spark):
    """Documents from (id, text) pairs, with a language and columns whose names clash with results."""

    def make(rows, extra: bool = False):
        df = spark.createDataFrame(
            [(i, t, "en", "s", len(t or "")) for i, t in rows],
            "doc_id bigint, text string, lang string, source string, n_chars bigint",
        )
        if extra:
            from pyspark.sql import functions as F

            clash = ("Shard", "slot", "bucket", "N_words", "kept", "spans", "found", "dropped", "n_bytes")
            df = df.withColumns({c: F.lit("x") for c in clash})
        return df

    return make
