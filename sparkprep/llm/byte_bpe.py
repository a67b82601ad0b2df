"""Byte-level BPE with a queue of merge ranks over a hierarchical bitmap.

A pre-token is a linked list of parts, at first its bytes. Every pair of neighbours that has a merge
waits in the bucket of its rank. A bitmap has a bit for each bucket that holds something, and a bitmap above
it a bit for each of its words that is not zero; so the least waiting rank is found by the first set
bit of one word a level. The bucket's pairs are merged from left to right. A merge changes the pairs on
both sides, whose old entries stay where they are and are skipped as stale when met. Each merge costs a
bounded number of steps, however long the pre-token, in place of a search through all pairs.

Merges in one pre-token do not touch another, so the pre-tokens of a batch of texts that are not known
yet share one queue: their lists lie end to end in the same arrays.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.bpe import vocabulary_path
from sparkprep.llm.common import documents, pieces

REMEMBERED, LONGEST_REMEMBERED = 200_000, 48
"""Encodings of so many pre-tokens of so many characters at most are kept by a task, twice over."""

TEXT_BYTES = 1 << 20
"""Bytes of text, or a single text, that are encoded together."""


class ByteBpe:
    """Encoder and decoder for a file of byte strings with their ranks, as ``tiktoken`` reads.

    ``pattern`` cuts a text into pre-tokens, which never merge with each other. A pre-token that is a
    token itself is that token. Every byte must have a rank.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.pattern = regex.compile(pattern)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        # Python's integers make bitmap words of any width, so two levels do
        self.shift = max(1, max(self.tokens).bit_length() // 2)
        self.words = [0] * ((max(self.tokens) >> self.shift) + 1)
        self.bits = [1 << k for k in range(max(len(self.words), 1 << self.shift))]
        self.remembered = REMEMBERED
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def encode_all(self, given: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of pre-tokens, each by itself; no two bytes of different ones merge.

        The queue's steps are written out in the loop: calls would double the time.
        """
        rank_of = self.ranks.get
        data = b"".join(given)
        n = len(data)
        ends = array("q", range(1, n + 1))  # of the part that begins here
        before = array("q", range(-1, n - 1))  # where the part before it begins
        begins = bytearray(n + 1)  # whether a pre-token does
        begins[n] = 1
        # rank of merging with the next part
        waiting = array("q", [rank_of(data[k : k + 2], -1) for k in range(n)])
        at = 0
        for piece in given:
            begins[at], before[at] = 1, -1
            at += len(piece)
            waiting[at - 1] = -1

        shift, words, bits = self.shift, self.words, self.bits  # all words are zero before and after
        mask, top = (1 << shift) - 1, 0
        buckets: dict[int, array] = {}
        for k, rank in enumerate(waiting):
            if rank in buckets:
                buckets[rank].append(k)
            elif rank >= 0:
                buckets[rank] = array("q", (k,))
                words[rank >> shift] |= bits[rank & mask]
                top |= bits[rank >> shift]
        while top:
            word = (top & -top).bit_length() - 1
            held = words[word]
            first = held & -held
            least = (word << shift) + first.bit_length() - 1
            words[word] = held = held ^ first
            if not held:
                top &= top - 1
            positions = buckets.pop(least)
            if len(positions) > 1:
                positions = sorted(positions)  # from left to right
            for place, left in enumerate(positions):
                if waiting[left] != least:
                    continue  # stale: merged away, or its neighbour was
                right = ends[left]
                end = ends[right]
                ends[left] = end
                waiting[left] = waiting[right] = -1
                lower = False
                if not begins[end]:
                    before[end] = left
                    rank = rank_of(data[left : ends[end]], -1)
                    if rank >= 0:
                        waiting[left] = rank
                        lower = rank < least
                        if rank in buckets:
                            buckets[rank].append(left)
                        else:
                            buckets[rank] = array("q", (left,))
                            words[rank >> shift] |= bits[rank & mask]
                            top |= bits[rank >> shift]
                previous = before[left]
                if previous >= 0:
                    waiting[previous] = rank = rank_of(data[previous:end], -1)
                    if rank >= 0:
                        lower = lower or rank < least
                        if rank in buckets:
                            buckets[rank].append(previous)
                        else:
                            buckets[rank] = array("q", (previous,))
                            words[rank >> shift] |= bits[rank & mask]
                            top |= bits[rank >> shift]
                if lower:  # that goes first, and the rest of this bucket waits again
                    rest = positions[place + 1 :]
                    if rest:
                        buckets[least] = array("q", rest)
                        words[least >> shift] |= bits[least & mask]
                        top |= bits[least >> shift]
                    break
        found, ids, at = [], [], 0
        while at < n:
            end = ends[at]
            ids.append(rank_of(data[at:end]))
            at = end
            if begins[at]:
                found.append(tuple(ids))
                ids = []
        return found

    def _learn(self, wanted: set[str]) -> None:
        """Put the ids of all these pre-tokens into ``known``."""
        known, older, ranks = self.known, self.older, self.ranks
        new, spelled = [], []
        for piece in wanted:
            if piece in known:
                continue
            ids = older.get(piece)
            if ids is None:
                data = piece.encode()
                whole = ranks.get(data)
                if whole is None:
                    new.append(piece)
                    spelled.append(data)
                    continue
                ids = (whole,)
            known[piece] = ids
        if new:
            known.update(zip(new, self.encode_all(spelled)))

    def _forget(self, wanted: set[str]) -> None:
        """Keep what is remembered within its bounds."""
        for piece in wanted:
            if len(piece) > LONGEST_REMEMBERED:
                self.known.pop(piece, None)
        if len(self.known) >= self.remembered:
            self.known, self.older = {}, self.known

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        split = [self.pattern.findall(text) for text in texts]
        wanted = set(chain.from_iterable(split))
        self._learn(wanted)
        ids = self.known.__getitem__
        found = [list(chain.from_iterable(map(ids, given))) for given in split]
        self._forget(wanted)
        return found

    def encode(self, text: str) -> list[int]:
        return self.encode_texts([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_CODERS: dict[tuple[str, str], ByteBpe] = {}


def coder(path: str, pattern: str) -> ByteBpe:
    """One coder for each worker process, file and pattern."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = ByteBpe(path, pattern)
    return _CODERS[path, pattern]


def public_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _coded(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...], made: str, describe) -> DataFrame:
    """``keep`` columns with what ``describe`` makes of each row's ids and decoded bytes."""
    kept = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    kinds = docs.sparkSession.createDataFrame([], made).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in pieces(batches, "_text", TEXT_BYTES):
            found = bpe.encode_texts(batch.column("_text").to_pylist())
            rows = [describe(ids, bpe.decode(ids)) for ids in found]
            columns = {c: batch.column(c) for c in keep}
            for k, field in enumerate(arrow):
                columns[field.name] = pa.array([r[k] for r in rows], field.type)
            yield pa.RecordBatch.from_pydict(columns)

    given = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    return given.mapInArrow(run, f"{schema}, {made}")


def byte_encode_documents(
    docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns with ``ids`` (32-bit) and the ``decoded`` bytes of each row's text.

    ``path`` is the rank file's place on the executors. NULL and empty texts have no ids and decode to
    no bytes. Every row has a result of its own, repeated ones too, and columns not in ``keep`` are not
    read; those in it must not be named ``ids`` or ``decoded``. A pre-token of any length takes time in
    proportion to it, and memory of some 100 bytes a byte.
    """
    return _coded(docs, path, pattern, keep, "ids array<int>, decoded binary", lambda ids, data: (ids, data))


def _digests(ids: list[int], data: bytes) -> tuple[int, str, str]:
    packed = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(data).hexdigest()


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document, decoded again, as counts and digests."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")
    made = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _coded(docs, vocabulary_path("byte_bpe_50k.tiktoken"), public_pattern(), ("doc_id",), made, _digests)
