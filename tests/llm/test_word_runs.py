import hashlib
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import ODD
from sparkprep.llm.word_runs import (
    SquareCatcher,
    collapsed,
    find_word_runs,
    op13_periodic_runs,
    periodic_runs,
    planted,
    strongest,
)


def brute_force(words, least_length=24, least_periods=3):
    """Every period tried at every place; of one stretch the smallest period counts."""
    n, smallest = len(words), {}
    for period in range(1, n // least_periods + 1):
        start = 0
        while start + period < n:
            end = start
            while end + period < n and words[end] == words[end + period]:
                end += 1
            if end + period - start >= max(least_length, least_periods * period):
                smallest.setdefault((start, end + period), period)
            start = end + 1
    return sorted((s, e - s, q) for (s, e), q in smallest.items())


def repetitive(rng, size):
    """Words of few kinds with copied stretches, powers of short words, and powers of powers."""
    words = []
    while len(words) < size:
        unit = [rng.choice("abcdefgh"[: rng.randint(1, 8)]) for _ in range(rng.randint(1, 12))]
        for _ in range(rng.randint(0, 2)):
            unit = unit * rng.randint(1, 4) + unit[: rng.randint(0, len(unit))]
        words += unit * rng.randint(1, 6)
        if words and rng.random() < 0.3:
            k = rng.randrange(len(words))
            words += words[k : k + rng.randint(1, 60)]
    return words[:size]


@pytest.mark.parametrize("seed", range(60))
def test_equal_to_brute_force(seed):
    rng = random.Random(seed)
    words = repetitive(rng, rng.randint(1, 500))
    assert find_word_runs(words) == brute_force(words)
    assert find_word_runs(words, 6) == brute_force(words, 6)
    assert find_word_runs(words, 50, 4) == brute_force(words, 50, 4)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=90), st.integers(3, 30))
def test_equal_on_two_words(words, least):
    assert find_word_runs(words, least) == brute_force(words, least)


@pytest.mark.parametrize("seed", range(8))
def test_pieces_do_not_matter(seed):
    rng = random.Random(seed)
    words = repetitive(rng, 400)
    numbers = np.array([ord(w) for w in words])
    expected = brute_force(words)
    for most in (1, 7, 100):
        catcher, k = SquareCatcher(), 0
        while k < len(numbers):
            step = rng.randint(1, most)
            catcher.append(numbers[k : k + step])
            k += step
        assert catcher.runs() == expected
    one_by_one = SquareCatcher()
    for k in range(len(numbers)):
        one_by_one.append(numbers[k : k + 1])
        if k % 37 == 0:
            assert one_by_one.runs() == brute_force(words[: k + 1])


def test_words_whose_hashes_are_alike():
    """Two equally long Thue-Morse words have one polynomial hash modulo 2**64, whatever the base."""
    word = [0]
    for _ in range(11):
        word += [1 - w for w in word]
    other = [1 - w for w in word]
    assert find_word_runs(word + other + word) == []
    assert find_word_runs((word + other) * 3 + word[:100]) == [(0, 3 * 4096 + 100, 4096)]
    assert find_word_runs(word * 3 + [2]) == [(0, 3 * 2048, 2048)]


def test_long_text_of_one_word():
    begun = time.time()
    words = ["a"] * 300_000 + [f"w{k}" for k in range(100_000)] + ["x", "y"] * 100_000
    assert find_word_runs(words) == [(0, 300_000, 1), (400_000, 200_000, 2)]
    assert time.time() - begun < 20


def test_strongest_and_collapsed():
    words = list("abababab") * 3 + list("xyz") * 8 + ["end"]
    runs = find_word_runs(words)
    assert runs == [(0, 24, 2), (24, 24, 3)]
    assert strongest(runs) == (0, 24, 2) and strongest([]) is None
    assert strongest([(0, 30, 10), (5, 60, 20), (7, 31, 10)]) == (7, 31, 10)
    assert strongest([(0, 30, 10), (5, 60, 20)]) == (0, 30, 10)
    assert collapsed(words, runs) == [*"abxyz", "end"]


def test_odd_rows(spark, table, prose):
    long = (prose(20_000, 1) + " ") * 3
    rows = [*ODD, (8, "a " * 30), (9, "\x1c\x85\xa0 " * 30), (10, long)]
    found = {(r.doc_id, r.collapsed): r for r in periodic_runs(table(rows, extra=True)).collect()}
    assert len(found) == len(rows) - 1  # one row is there twice
    assert found[8, "a"].runs[0].asDict() == {"start": 0, "length": 30, "period": 1}
    assert found[9, "\x1c\x85\xa0"].n_words == 30
    assert found[10, " ".join(long.split()[:20_000])].strongest.period == 20_000
    assert found[1, ""].runs == [] and found[1, ""].strongest is None and found[1, ""].n_words == 0
    assert periodic_runs(table([])).count() == 0


def expected_row(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    runs = brute_force(words)
    kept = [True] * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = [False] * (length - period)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for w, k in zip(words, kept) if k)).hexdigest(),
    )


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = op13_periodic_runs(spark, sf)
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(docs) and sum(r[1] for r in rows) > 0
    for row in rows:
        if len((docs[row[0]] or "").split()) <= 3000:
            assert row == expected_row(row[0], docs[row[0]])
