"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts (questions and answers) and documents are normalised alike: A-Z lower-cased, runs of
other ASCII than letters and digits as one space. Every window of an item's words is a pattern of the
automaton, whose letters are words: each word of the benchmark has a character of its own, and all others
share one that is in no pattern. So a window has as many states as words. A document is scanned once, and
matches are mapped back to its words and characters. An automaton holds at most ``MOST_WORDS`` words of
benchmark; a larger one takes several scans, one after the other.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import documents, dropping, pieces
from sparkprep.workspace import settle

# Bytes of words are kept, A-Z lower-cased; every other ASCII byte is a space. Bytes of other
# characters are all word bytes, so UTF-8 needs no decoding.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or b > 0x7F or 0x61 <= b <= 0x7A else 32
    for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")


def folded_words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


MOST_WORDS = 1 << 20
"""Words of benchmark in one automaton: about half a GB at most, and fewer than there are characters."""


def _letter(number: int) -> str:
    """Characters from 1 on, without surrogates."""
    return chr(number + 1 if number + 1 < 0xD800 else number + 1 + 0x800)


class Patterns:
    """An automaton over the windows of benchmark items; its letters are words."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.letters: dict[bytes, str] = {}
        owners: dict[str, tuple[str, ...]] = {}
        alike: dict[tuple[str, ...], tuple[str, ...]] = {}  # equal lists of items are held once
        for item, text in items:
            words = folded_words(text)
            for word in words:
                if word not in self.letters:
                    self.letters[word] = _letter(len(self.letters))
            line = "".join(map(self.letters.__getitem__, words))
            for start in range(max(1, len(line) - window + 1) if line else 0):
                pattern = line[start : start + window]
                held = owners.get(pattern, ())
                if item not in held:
                    found = (*held, item)
                    owners[pattern] = alike.setdefault(found, found)
        self.automaton = ahocorasick.Automaton()
        values = {}
        for pattern, found in owners.items():
            value = (len(pattern), found)
            self.automaton.add_word(pattern, values.setdefault(value, value))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """How many words the text has, the word ranges that windows cover, and their items."""
        words = folded_words(text)
        if self.empty or not words:
            return len(words), [], set()
        ranges: list[tuple[int, int]] = []
        items: set[str] = set()
        for end, (size, owners) in self.automaton.iter("".join(map(self.letters.get, words, repeat("\0")))):
            first, stop = end + 1 - size, end + 1
            if ranges and ranges[-1][0] <= first <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(stop, ranges[-1][1]))
            else:
                ranges.append((first, stop))
            items.update(owners)
        return len(words), joined(ranges), items


_built: dict[str, Patterns] = {}


def _patterns(name: str, items: list[tuple[str, str]], window: int) -> Patterns:
    """The automaton of a scan, built once by each Python worker, which holds no other."""
    if name not in _built:
        _built.clear()
        _built[name] = Patterns(items, window)
    return _built[name]


def shares(items: list[tuple[str, str]], window: int, most_words: int) -> list[list[tuple[str, str]]]:
    """The items in lists of at most ``most_words`` words; a longer item is cut, no window of it lost."""
    if most_words <= window:
        raise ValueError(f"most_words must be over the window of {window}")
    out: list[list[tuple[str, str]]] = [[]]
    held = 0
    for item, text in items:
        words = folded_words(text)
        step = most_words - window + 1
        for start in range(0, max(1, len(words) - window + 1), step):
            part = words[start : start + most_words]
            if held + len(part) > most_words:
                out.append([])
                held = 0
            out[-1].append((item, b" ".join(part).decode()))
            held += len(part)
    return out


def joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open ranges, in order."""
    out: list[tuple[int, int]] = []
    for first, stop in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((first, stop))
    return out


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Character ranges, in the text as given, of ranges of its words."""
    if not ranges:
        return []
    data = text.encode()
    places = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
    # a byte that begins a character, counted up to each place
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    return [
        {"start": int(chars[places[a][0]]), "end": int(chars[places[b - 1][1]])} for a, b in ranges
    ]


_RANGES = "_ranges"
FOUND = (
    "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>, "
    f"{_RANGES} array<array<int>>"
)
_ADDED = ("n_words", "n_hit", "items", "spans")


def _scan(docs: DataFrame, items: list[tuple[str, str]], window: int, text: str) -> DataFrame:
    """``docs`` with what an automaton over ``items`` finds, and with what an earlier scan found."""
    sent = docs.sparkSession.sparkContext.broadcast(items)
    name = uuid.uuid4().hex
    again = _RANGES in docs.columns
    kept = [c for c in docs.columns if not again or c not in (*_ADDED, _RANGES)]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = _patterns(name, sent.value, window)
        for batch in pieces(batches, text, 8 << 20):
            texts = batch.column(text).to_pylist()
            if again:
                before = zip(batch.column(_RANGES).to_pylist(), batch.column("items").to_pylist())
            else:
                before = (([], []) for _ in texts)
            n_words, n_hit, found, spans, all_ranges = [], [], [], [], []
            for value, (old_ranges, old_items) in zip(texts, before):
                words, ranges, owners = patterns.scan(value or "")
                if old_ranges:
                    ranges = joined([*ranges, *map(tuple, old_ranges)])
                n_words.append(words)
                n_hit.append(sum(b - a for a, b in ranges))
                found.append(sorted(owners.union(old_items)))
                spans.append(original_spans(value, ranges) if ranges else [])
                all_ranges.append(ranges)
            columns = {c: batch.column(c) for c in kept}
            columns |= {
                "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "items": pa.array(found, pa.list_(pa.string())),
                "spans": pa.array(spans, span),
                _RANGES: pa.array(all_ranges, pa.list_(pa.list_(pa.int32()))),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, f"{schema}, {FOUND}")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    most_bytes: int = 64 << 20,
    text: str = "text",
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """``docs`` with the benchmark windows that occur in each text.

    Adds ``n_words``, ``n_hit`` (words inside a window's occurrence), ``items`` (ids as strings,
    sorted) and ``spans`` (character ranges of the text as given). A NULL text has no words. An item
    of fewer words than ``window`` is one pattern; one of none, or a NULL one, has no pattern. Items
    with equal windows are all named. Given columns of these names are replaced.

    The benchmark is sent to every executor, so its size is checked first: ``most_bytes`` bounds its text,
    and a larger one is refused, to be split by the caller. One with over ``most_words`` words takes several
    scans, each with an automaton of its own and its result written before the next.
    """
    docs = dropping(docs, *_ADDED, _RANGES)
    given = benchmark.where(F.col("text").isNotNull())
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"the benchmark has {size} bytes of text; {most_bytes} can be sent")
    rows = given.select(F.col("item_id").cast("string"), F.col("text").cast("string")).collect()
    scans = shares([(r[0] or "", r[1]) for r in rows], window, most_words)
    for number, items in enumerate(scans):
        if number:  # Spark would run the scans of one stage side by side
            docs = settle(docs, "decontaminate-scan")
        docs = _scan(docs, items, window, text)
    return docs.drop(_RANGES)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside benchmark windows, and the items they are from."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")
    found = find_contamination(docs, documents(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
