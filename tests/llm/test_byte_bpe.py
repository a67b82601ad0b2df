import hashlib
import random
import struct
import time

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import ODD
from sparkprep.llm.byte_bpe import ByteBpe, byte_encode_documents, op11_byte_bpe, public_pattern

PATHS = [public_tokenizers.path(f"byte_bpe_{name}.tiktoken") for name in ("50k", "multi_50k")]
CODERS = {path: ByteBpe(path, public_pattern()) for path in PATHS}
LIBRARY = {
    path: tiktoken.Encoding("own", pat_str=public_pattern(), mergeable_ranks=coder.ranks, special_tokens={})
    for path, coder in CODERS.items()
}


def check(texts):
    for path in PATHS:
        for text in texts:
            ids = CODERS[path].encode(text)
            assert ids == LIBRARY[path].encode_ordinary(text), text[:100]
            assert CODERS[path].decode(ids) == text.encode()


def test_same_as_library_on_every_character():
    check([f"a{chr(k)}b {chr(k)}{chr(k)} 1{chr(k)}" for k in range(0x3000)])
    check([chr(k) + "x" + chr(k) for k in range(0x3000, 0x110000, 7) if not 0xD800 <= k < 0xE000])


def test_same_as_library_on_odd_texts():
    rng = random.Random(3)
    alphabet = [chr(k) for k in range(1, 0x250)] + list("漢字かなजु́̈😀👍 ​﻿") + [
        "<|endoftext|>", "'s", "'LL", "'re", "  ", " \n", "\r\n", "the", " of"
    ]
    check(["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(2000)])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_same_as_library_on_any_text(text):
    check([text])


def test_same_as_library_without_pre_tokens():
    """Long runs of letters are one pre-token; bytes need not be text."""
    rng = random.Random(4)
    coder, library = CODERS[PATHS[0]], LIBRARY[PATHS[0]]
    for letters in ("ab", "abthein", "etaoinshrdlu", "é漢a"):
        text = "".join(rng.choice(letters) for _ in range(4000))
        assert coder.encode(text) == library.encode_ordinary(text)
    check(["a" * 30_000, "the" * 9_000, "=" * 5_000, " " * 5_000 + "x"])


def plain_merges(ranks, data):
    """The least rank first, the leftmost of several; by searching all pairs."""
    parts = [data[k : k + 1] for k in range(len(data))]
    while True:
        found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, k = min(found)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_ranks_in_any_order(tmp_path):
    """Merges may make pairs of a lower rank than their own: those go first."""
    import base64

    rng = random.Random(5)
    for trial in range(40):
        letters = [b"a", b"b", b"c"]
        tokens = set(letters)
        while len(tokens) < 40:
            tokens.add((rng.choice(sorted(tokens)) + rng.choice(sorted(tokens)))[:9])
        rest = sorted(tokens - set(letters))
        rng.shuffle(rest)
        path = tmp_path / f"{trial}.ranks"
        numbered = [*letters, *rest]
        path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % k for k, t in enumerate(numbered)))
        coder = ByteBpe(str(path), public_pattern())
        given = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 60))) for _ in range(30)]
        expected = [tuple(plain_merges(coder.ranks, data)) for data in given]
        assert coder.encode_all(given) == expected
        assert [coder.encode_all([data])[0] for data in given] == expected


def test_words_are_forgotten():
    """What is remembered stays bounded, and no id depends on it."""
    rng = random.Random(8)
    coder, library = ByteBpe(PATHS[0], public_pattern()), LIBRARY[PATHS[0]]
    coder.remembered = 50
    for _ in range(200):
        texts = [" ".join(f"w{rng.randint(0, 90)}x" for _ in range(20)) + " " + "z" * 60 for _ in range(3)]
        assert coder.encode_texts(texts) == [library.encode_ordinary(t) for t in texts]
        assert len(coder.known) < 50 and len(coder.older) < 200
        assert not any(len(p) > 48 for p in [*coder.known, *coder.older])


@pytest.mark.parametrize("unit", ["a", "the", "xqz"])
def test_long_pre_token(unit):
    begun = time.time()
    text = unit * (600_000 // len(unit))
    coder = CODERS[PATHS[0]]
    ids = coder.encode(text)
    assert not any(coder.words)
    assert coder.decode(ids) == text.encode()
    assert time.time() - begun < 30


def test_odd_rows(spark, table, prose):
    rows = [*ODD, (8, "ab" * 100_000), (9, prose(30_000, 2))]
    library = LIBRARY[PATHS[0]]
    found = byte_encode_documents(table(rows, extra=True), PATHS[0], public_pattern(), ("doc_id", "slot"))
    texts = sorted((i or -1, t or "") for i, t in rows)
    given = sorted((r.doc_id or -1, bytes(r.decoded).decode(), tuple(r.ids)) for r in found.collect())
    assert [g[:2] for g in given] == texts
    assert all(list(ids) == library.encode_ordinary(text) for _, text, ids in given)
    assert byte_encode_documents(table([]), PATHS[0], public_pattern()).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    library, rows = LIBRARY[PATHS[0]], op11_byte_bpe(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
