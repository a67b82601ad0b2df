"""Periodic runs of words, found by catching squares online over dyadic blocks.

Words are appended to a :class:`SquareCatcher`, in pieces of any size. At each level the blocks of
``2**k`` words that are complete have a catcher, which waits for the block to come again at a distance
of ``2**k`` to ``2**(k+1) - 1`` words. An appended word completes one suffix a level, and that suffix
falls to just one catcher: the block before the one it begins in. A suffix that equals its block is a
repeat; it is stretched both ways as far as its distance stays a period, it is a square when it
reaches two periods, and squares of one period that touch are one run. Repeats that reach the last
word stay open, and appended words carry them on. Suffixes are compared by hash, and what is equal is
compared again word by word, so no result rests on a hash.

A run of three periods holds a whole block of its level in its first two periods, so none is missed.
Each word costs one comparison a level, and each repeat the length it is stretched over.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import documents, pieces
from sparkprep.llm.hashing import BASE, mixed

Run = tuple[int, int, int]
"""Start, length and period, in words."""

LEAST_LENGTH, LEAST_PERIODS = 24, 3
APPENDED = 1 << 16
"""Words appended at a time."""

_INVERSE = pow(BASE, -1, 1 << 64)


class _Growing:
    """A numpy array that is appended to."""

    def __init__(self, kind: type):
        self.held, self.size = np.empty(64, kind), 0

    def append(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.held):
            grown = np.empty(max(size, 2 * len(self.held)), self.held.dtype)
            grown[: self.size] = self.held[: self.size]
            self.held = grown
        self.held[self.size : size] = values
        self.size = size

    @property
    def values(self) -> np.ndarray:
        return self.held[: self.size]


class SquareCatcher:
    """Finds the runs of a growing sequence of word numbers.

    A run keeps its smallest period over at least ``least_length`` words and ``least_periods`` (three
    or more) periods, and no neighbouring word carries it on.
    """

    def __init__(self, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS):
        if least_periods < 3 or least_length < 3:
            raise ValueError("a run has three periods and three words at least")
        self.least_length, self.least_periods = least_length, least_periods
        # shorter blocks need no catcher: a run has this many words, so a block of this width recurs
        self.base = 1 << ((least_length // 3).bit_length() - 1)
        self._words, self._sums, self._inverse = _Growing(np.int64), _Growing(np.uint64), _Growing(np.uint64)
        self._sums.append(np.zeros(1, np.uint64))
        self._power = 1
        self._inverse_power = 1
        self.ends: dict[tuple[int, int], int] = {}  # of each (start, period)
        self.latest: dict[int, int] = {}  # of each period: the start of its last repeat
        self.open: set[tuple[int, int]] = set()

    def append(self, words: np.ndarray) -> None:
        before = self._words.size
        if not len(words):
            return
        self._words.append(words)
        self._hash(words)
        self._carry_on(before)
        width = self.base
        while 2 * width <= self._words.size or width == self.base:
            self._catch(width, before)
            width *= 2

    def _hash(self, words: np.ndarray) -> None:
        factors = np.full(len(words) + 1, BASE, np.uint64)
        inverses = np.full(len(words) + 1, _INVERSE, np.uint64)
        factors[0], inverses[0] = self._power, self._inverse_power
        factors, inverses = np.multiply.accumulate(factors), np.multiply.accumulate(inverses)
        terms = mixed(words.astype(np.uint64) + np.uint64(1)) * factors[:-1]
        self._sums.append(np.cumsum(terms) + self._sums.values[-1])
        self._inverse.append(inverses[:-1])
        self._power, self._inverse_power = int(factors[-1]), int(inverses[-1])

    def _forwards(self, end: int, period: int) -> int:
        """How far a repeat that holds up to ``end`` goes on."""
        words, step = self._words.values, 64
        while end < len(words):
            stop = min(end + step, len(words))
            differ = words[end:stop] != words[end - period : stop - period]
            if differ.any():
                return end + int(differ.argmax())
            end, step = stop, 2 * step
        return end

    def _backwards(self, start: int, period: int) -> int:
        words, step = self._words.values, 64
        while start > 0:
            stop = max(start - step, 0)
            differ = words[stop:start] != words[stop + period : start + period]
            if differ.any():
                return start - int(differ[::-1].argmax())
            start, step = stop, 2 * step
        return start

    def _keep(self, start: int, end: int, period: int) -> None:
        """Note a repeat that is a square, or may become one."""
        key = (start, period)
        if end == self._words.size:
            self.open.add(key)
        else:
            self.open.discard(key)
        if end - start >= 2 * period or end == self._words.size:
            self.ends[key] = end
            self.latest[period] = start
        else:
            self.ends.pop(key, None)

    def _carry_on(self, before: int) -> None:
        for start, period in list(self.open):
            self._keep(start, self._forwards(before, period), period)

    def _catch(self, width: int, before: int) -> None:
        """Compare the suffixes that were completed since ``before`` with the blocks of one level."""
        size = self._words.size
        first, last = max(before - width + 1, 1), size - width
        if last < first:
            return
        # hashes from the first block that any of these suffixes may equal
        origin = max(first // width - 1, 0) * width
        sums = self._sums.values[origin:]
        hashes = (sums[width:] - sums[:-width]) * self._inverse.values[origin : size - width + 1]
        blocks = np.repeat(hashes[::width], width)
        found = []
        start = max(first, origin + width)
        if start <= last:
            same = hashes[start - origin :] == blocks[start - origin - width : last + 1 - origin - width]
            starts = np.flatnonzero(same) + start
            found.append((starts // width * width - width, starts))
        if width == self.base:  # and nearer than a block's width
            same = hashes[first - origin :] == blocks[first - origin : last + 1 - origin]
            starts = np.flatnonzero(same) + first
            starts = starts[starts % width > 0]
            found.append((starts // width * width, starts))
        for block, starts in found:
            if len(starts):
                self._stretch(block, starts, width)

    def _stretch(self, blocks: np.ndarray, starts: np.ndarray, width: int) -> None:
        ends = starts + width
        if self.ends:
            # inside a repeat of a lower level a longer distance is a multiple of that one's period
            held = sorted((s, e) for (s, q), e in self.ends.items() if q < width and e - s >= 2 * q)
            if held:
                begun, reached = np.array(held, np.int64).T
                reached = np.maximum.accumulate(reached)
                place = np.searchsorted(begun, blocks, "right") - 1
                inside = (place >= 0) & (reached[place] >= ends)
                blocks, starts, ends = blocks[~inside], starts[~inside], ends[~inside]
        words = self._words.values
        for block, start, end in zip(blocks.tolist(), starts.tolist(), ends.tolist()):
            period = start - block
            known = self.latest.get(period)
            if known is not None and known <= block and self.ends.get((known, period), 0) >= end:
                continue
            if np.array_equal(words[block : block + width], words[start:end]):
                self._keep(self._backwards(block, period), self._forwards(end, period), period)

    def runs(self) -> list[Run]:
        """The runs of all words so far, by start, then period."""
        smallest: dict[tuple[int, int], int] = {}
        for (start, period), end in self.ends.items():
            if end - start >= max(self.least_length, self.least_periods * period):
                where = (start, end)
                smallest[where] = min(period, smallest.get(where, period))
        return sorted((start, end - start, period) for (start, end), period in smallest.items())


def find_word_runs(words: list, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS) -> list[Run]:
    catcher = SquareCatcher(least_length, least_periods)
    numbers: defaultdict = defaultdict(count().__next__)
    for k in range(0, len(words), APPENDED):
        part = words[k : k + APPENDED]
        catcher.append(np.fromiter(map(numbers.__getitem__, part), np.int64, len(part)))
    return catcher.runs()


def strongest(runs: list[Run]) -> Run | None:
    """The run of most periods; the first of several, and of those the one of the smallest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without the repetitions: of each run, what follows its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return list(compress(words, kept.tolist()))


def planted(doc_id: int | None, words: list) -> list:
    """A tenth of the documents, by the checksum of the id, with a stretch of their words repeated."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def periodic_runs(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_periods: int = LEAST_PERIODS,
    rewrite: Callable[[int | None, list], list] | None = None,
) -> DataFrame:
    """``(doc_id, n_words, runs, strongest, collapsed)`` for each row.

    ``runs`` are ``(start, length, period)`` by start, then period; ``strongest`` is one of them, NULL
    without runs; ``collapsed`` is the text's words joined by one space, each run cut to one period.
    ``rewrite`` may change the words of a text first. Rows stand alone, so repeated rows and ids give
    a result each. NULL, empty and blank texts have no words and no run; other columns are not read.
    A text is worked on whole in one task, in memory in proportion to it.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", 4 << 20):
            ids = batch.column("doc_id").to_pylist()
            rows: dict[str, list] = {c: [] for c in ("n_words", "runs", "strongest", "collapsed")}
            for doc_id, text in zip(ids, batch.column("_text").to_pylist()):
                words = text.split()
                if rewrite:
                    words = rewrite(doc_id, words)
                runs = find_word_runs(words, least_length, least_periods)
                rows["n_words"].append(len(words))
                rows["runs"].append([dict(zip(("start", "length", "period"), r)) for r in runs])
                best = strongest(runs)
                rows["strongest"].append(best and dict(zip(("start", "length", "period"), best)))
                rows["collapsed"].append(b" ".join(collapsed(words, runs)).decode())
            kinds = (pa.int64(), pa.list_(run_kind), run_kind, pa.large_string())
            columns = {c: pa.array(v, kind) for (c, v), kind in zip(rows.items(), kinds)}
            columns["collapsed"] = columns["collapsed"].cast(pa.string())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **columns})

    run_kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    run = "struct<start:bigint,length:bigint,period:bigint>"
    # bytes split at \x20 and \x09-\x0D only
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_text")
    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(
        find, f"doc_id bigint, n_words bigint, runs array<{run}>, strongest {run}, collapsed string"
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of each whole document, a tenth of them with planted ones, as figures and digests."""
    found = periodic_runs(documents(spark, sf_dir), rewrite=planted)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.lit("\n"))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(best[c].alias(c) for c in ("start", "length", "period")),
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, lines).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
