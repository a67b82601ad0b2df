import hashlib
import random
import re

import pytest

from sparkprep.llm.decontaminate import Patterns, find_contamination, op5_decontamination, shares
from cases import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def brute(texts, items, window):
    owners = {}
    for item, text in items:
        words = WORD.findall(lower(text or ""))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            owners.setdefault(tuple(words[k : k + window]), set()).add(str(item))
    sizes = {len(w) for w in owners}
    out = []
    for text in texts:
        words, hit, found = WORD.findall(lower(text or "")), set(), set()
        for k in range(len(words)):
            for n in sizes:
                who = owners.get(tuple(words[k : k + n])) if k + n <= len(words) else None
                if who:
                    hit |= set(range(k, k + n))
                    found |= who
        out.append((len(words), len(hit), sorted(found)))
    return out


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute([d.text for d in docs], items, 10)
    found = op5_decontamination(spark, sf).orderBy("doc_id").collect()
    assert len(found) == len(docs)
    for r, (n, hit, owners) in zip(found, expected):
        digest = hashlib.sha256(",".join(owners).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(owners), digest)
        assert r.contaminated == (hit > 0)


def test_windows_ties_and_short_items(spark, table):
    items = [(1, "A b-c!"), (2, "a B c"), (3, "x y z w"), (4, None), (5, "..."), (6, "q")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    texts = ["zz a,b\n c x Y z", "Q", "x y z w é", "ab c", None, "", "a b c a b c b c a"]
    found = find_contamination(table(list(enumerate(texts)), extra=True), benchmark, window=3)
    rows = found.orderBy("doc_id").collect()
    for r, (n, hit, owners) in zip(rows, brute(texts, items, 3)):
        assert (r.n_words, r.n_hit, r["items"]) == (n, hit, owners)
    assert [texts[0][s.start : s.end] for s in rows[0].spans] == ["a,b\n c x Y z"]


def test_odd_rows_and_bounds(spark, table):
    benchmark = spark.createDataFrame([(1, "alike")], "item_id bigint, text string")
    assert sum(r.n_hit for r in find_contamination(table(ODD), benchmark).collect()) == 2
    assert find_contamination(table([]), benchmark).count() == 0
    assert find_contamination(table(ODD), benchmark.limit(0)).where("n_hit > 0").count() == 0
    with pytest.raises(ValueError):
        find_contamination(table(ODD), benchmark, most_bytes=3)


def test_empty_patterns():
    assert Patterns([], 10).scan("a b") == (2, [], set())


def test_several_scans(spark, table):
    """Windows and items of a benchmark that is split, one item longer than a scan can hold."""
    rng = random.Random(3)
    some = [f"W{i}é" for i in range(12)]
    prose = lambda n: " ".join(rng.choice(some) for _ in range(n))
    items = [(i, prose(rng.choice([1, 2, 3, 5, 9, 40]))) for i in range(30)]
    texts = [prose(rng.randrange(60)) for _ in range(40)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(shares([(str(i), t) for i, t in items], 3, 20)) > 5
    found = find_contamination(table(list(enumerate(texts)), extra=True), benchmark, window=3, most_words=20)
    rows = found.orderBy("doc_id").collect()
    for r, (n, hit, owners) in zip(rows, brute(texts, items, 3)):
        assert (r.n_words, r.n_hit, r["items"]) == (n, hit, owners)
    assert len(rows) == len(texts) and found.columns.count("n_words") == 1


def test_shares_lose_no_window():
    rng = random.Random(4)
    items = [(str(i), " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(50)))) for i in range(20)]
    windows = lambda given: {
        (i, tuple(t.split()[k : k + 4])) for i, t in given for k in range(max(1, len(t.split()) - 3)) if t
    }
    for most in (5, 9, 30, 1000):
        found = shares(items, 4, most)
        assert windows([x for part in found for x in part]) == windows(items)
        assert max(sum(len(t.split()) for _, t in part) for part in found) <= most


def test_very_long_text(spark, table):
    text = "own words only " * 100_000 + "a b c d " + "own words only " * 100_000
    benchmark = spark.createDataFrame([(1, "a b c d")], "item_id bigint, text string")
    (row,) = find_contamination(table([(1, text)]), benchmark).collect()
    assert (row.n_words, row.n_hit) == (600_004, 4)
    assert text[row.spans[0].start : row.spans[0].end] == "a b c d"
