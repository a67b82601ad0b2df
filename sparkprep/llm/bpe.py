"""BPE encoding by dynamic programming over prefixes, and decoding.

A string has one encoding, and so has each of its prefixes; so each prefix has one last token. Going
through a word's prefixes, an automaton over the vocabulary gives the tokens that are suffixes of the
prefix, and the last token is the one that can stand after the last token of the prefix before it. Two
tokens can stand side by side if the merges leave the pair as it is. Back-pointers from the
whole word then give its ids. The work is linear in a word's length, however long it is.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import documents, pieces

LAST_SYMBOL = 0x10000
"""Added to a word's last symbol, which the vocabulary spells with the end-of-word suffix."""

# Characters that normalise alike everywhere: ASCII and Latin letters with plain lower case.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-§©«°¶·¿-āČ-ďŐ-œ]*")
_PLAIN_WORDS = re.compile(
    r"[a-zß-öø-āčďőœ]+|[0-9]|'(?:[stmd]|re|ve|ll)"
    r"|[^\s0-9a-zß-öø-āčďőœ]+"
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


class Recent:
    """Answers for the keys asked lately, in two generations of bounded size."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key: str, work_out: Callable[[str], tuple]) -> tuple:
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = work_out(key)
            if len(self.new) >= self.size:
                self.old = self.new
                self.new = {}
            self.new[key] = found
        return found


class WordBpe:
    """Encoder and decoder for a ``tokenizers`` file of lower-cased BPE with word ends.

    ``remembered`` bounds how many words' encodings a task keeps; the rest is worked out again.
    """

    def __init__(self, path: str, remembered: int = 200_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.suffix = model["end_of_word_suffix"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.ranks = {(a, b): k for k, (a, b) in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.library = Tokenizer.from_file(path)  # for normalising unusual characters only
        self.specials = re.compile("|".join(map(re.escape, self.special)))
        self.symbols = byte_symbols()
        self.pieces = [""] * (max([*self.vocabulary.values(), *self.special.values()]) + 1)
        for piece, k in [*self.vocabulary.items(), *self.special.items()]:
            self.pieces[k] = piece
        self.automaton = ahocorasick.Automaton()
        self.spelled: dict[int, str] = {}
        for piece, k in self.vocabulary.items():
            spelled = self._spelled(piece)
            self.spelled[k] = spelled
            self.automaton.add_word(spelled, (k, len(spelled)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.remembered = remembered
        self.known_chunks, self.known_words = Recent(remembered), Recent(remembered)

    def _spelled(self, piece: str) -> str:
        """A token or word with its end-of-word suffix folded into the last symbol."""
        if piece.endswith(self.suffix) and len(piece) > len(self.suffix):
            bare = piece[: -len(self.suffix)]
            return bare[:-1] + chr(ord(bare[-1]) + LAST_SYMBOL)
        return piece

    def _symbol(self, char: str) -> str:
        return char if ord(char) < LAST_SYMBOL else chr(ord(char) - LAST_SYMBOL) + self.suffix

    def _merged(self, symbols: list[str]) -> list[str]:
        """Merge by rank until nothing merges; for short strings."""
        while len(symbols) > 1:
            ranked = [
                (self.ranks[pair], k)
                for k, pair in enumerate(zip(symbols, symbols[1:]))
                if pair in self.ranks
            ]
            if not ranked:
                break
            _, k = min(ranked)
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        return symbols

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens side by side; ``left`` -1 is a word's start."""
        tokens = [right] if left < 0 else [left, right]
        symbols = [self._symbol(c) for t in tokens for c in self.spelled[t]]
        return self._merged(symbols) == [self.pieces[t] for t in tokens]

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-token, spelled in byte symbols."""
        spelled = word[:-1] + chr(ord(word[-1]) + LAST_SYMBOL)
        last = [-1] * (len(spelled) + 1)  # of each prefix: its last token, and that one's length
        length = [0] * (len(spelled) + 1)
        pairs, width = self.pairs, len(self.pieces)
        for end, (token, size) in self.automaton.iter(spelled):
            end += 1
            before = end - size
            # a prefix has one last token, and one without an encoding is never part of the word's
            if length[end] or (before and not length[before]):
                continue
            pair = last[before] * width + token
            fits = pairs.get(pair)
            if fits is None:
                fits = pairs[pair] = self.compatible(last[before], token)
            if fits:
                last[end] = token
                length[end] = size
        ids, end = [], len(spelled)
        while end > 0:
            ids.append(last[end])
            end -= length[end]
        if len(pairs) >= self.remembered:
            pairs.clear()
        return tuple(reversed(ids))

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-token of plain text."""
        symbols = self.symbols
        return self.encode_word("".join([symbols[b] for b in word.encode()]))

    def chunk_ids(self, chunk: str) -> tuple[int, ...]:
        """Ids of a run of plain, lower-cased characters between white space."""
        words = _PLAIN_WORDS.findall(chunk)
        if len(words) == 1:
            return self.known_words.get(chunk, self.word_ids)
        get, encode = self.known_words.get, self.word_ids
        return tuple(chain.from_iterable([get(w, encode) for w in words]))

    def part_ids(self, text: str) -> Iterable[int]:
        """Ids of a text without special tokens."""
        if _PLAIN.fullmatch(text):
            get, encode = self.known_chunks.get, self.chunk_ids
            return chain.from_iterable([get(c, encode) for c in text.lower().split()])
        library = self.library
        words = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
        return chain.from_iterable([self.encode_word(w) for w, _ in words])

    def encode(self, text: str) -> list[int]:
        if "<|" not in text:
            return list(self.part_ids(text))
        ids: list[int] = []
        start = 0
        for mark in self.specials.finditer(text):
            ids += self.part_ids(text[start : mark.start()])
            ids.append(self.special[mark[0]])
            start = mark.end()
        return [*ids, *self.part_ids(text[start:])]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces, as the library decodes a file that names no decoder."""
        pieces = self.pieces
        return " ".join([pieces[k] for k in ids])


_ENCODERS: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """One encoder for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordBpe(path)
    return _ENCODERS[path]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(
    docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns with ``ids`` (32-bit) and the ``decoded`` string of each text.

    ``path`` is the vocabulary's place on the executors. NULL and empty texts have no ids and decode
    to an empty string.
    """
    kept = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in pieces(batches, "_text", 4 << 20):
            ids = [bpe.encode(t) for t in batch.column("_text").to_pylist()]
            decoded = [bpe.decode(i) for i in ids]
            columns = {c: batch.column(c) for c in keep}
            columns |= {"ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array(decoded)}
            yield pa.RecordBatch.from_pydict(columns)

    given = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return given.mapInArrow(run, f"{schema}, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """Counts and digests of each document's ids and decoded text, made where they are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in pieces(batches, "_text", 4 << 20):
            counts, ids_digests, decoded_digests = [], [], []
            for text in batch.column("_text").to_pylist():
                ids = bpe.encode(text)
                counts.append(len(ids))
                ids_digests.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                decoded_digests.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": pa.array(ids_digests),
                    "decoded_sha256": pa.array(decoded_digests),
                }
            )

    given = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("_text")
    )
    kinds = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return given.mapInArrow(run, kinds)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document, decoded again, as counts and digests."""
    return digest_documents(documents(spark, sf_dir), vocabulary_path())
