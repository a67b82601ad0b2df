import hashlib
import random
import struct

import pytest
from tokenizers import Tokenizer

from sparkprep.llm.bpe import WordBpe, encode_documents, op10_bpe, vocabulary_path
from cases import ODD

PATH = vocabulary_path()


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(PATH, remembered=500)  # so small that words are forgotten


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def check(bpe, library, texts):
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = bpe.encode(text)
        assert ids == found.ids, text[:100]
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_same_as_library_on_odd_characters(bpe, library):
    rng = random.Random(5)
    alphabet = [chr(k) for k in range(1, 0x250)] + list("ΣσςİΑ漢字かなजु́̈😀👍 ​﻿")
    alphabet += ["<|endoftext|>", "<|startoftext|>", "<|", "'s", "'LL", " ", "\n"]
    check(bpe, library, ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)])


def test_same_as_library_on_every_character(bpe, library):
    check(bpe, library, [f"{chr(k)}x{chr(k)}" for k in range(1, 0x3000)])


def test_same_as_library_on_runs_without_spaces(bpe, library):
    rng = random.Random(6)
    check(bpe, library, ["a" * 50_000, "the" * 20_000, "", "!" * 3000 + "'s"])
    check(bpe, library, ["".join(rng.choice("abthein") for _ in range(5000)) for _ in range(5)])


def test_unique_last_token(bpe):
    """Each prefix of a word has at most one token that fits."""
    for word in ("internationalisation", "heheheththeandin"):
        spelled = word[:-1] + chr(ord(word[-1]) + 0x10000)
        last = {0: -1}
        for end in range(1, len(spelled) + 1):
            fits = [
                token
                for token, piece in bpe.spelled.items()
                if spelled[:end].endswith(piece) and (end - len(piece)) in last
                and bpe.compatible(last[end - len(piece)], token)
            ]
            assert len(fits) <= 1
            if fits:
                last[end] = fits[0]


def test_odd_rows(spark, table, library):
    found = encode_documents(table(ODD, extra=True), PATH, keep=("doc_id", "spans")).collect()
    texts = {(i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD}
    assert {(r.doc_id, tuple(r.ids)) for r in found} == texts
    assert encode_documents(table([]), PATH).count() == 0


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op10_bpe(spark, sf).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
