import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cases import ODD
from sparkprep.llm import max_sketch
from sparkprep.llm.max_sketch import Queries, Scorer, build_index, op12_ranked_search, search
from sparkprep.workspace import settle

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k):
    """Every document scored for every item."""
    lists = [(i, words(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in lists), sum(len(w) for _, w in lists)
    rows = []
    for item, text in items:
        asked, scored = set(words(text)), []
        df = {t: sum(t in w for _, w in lists) for t in asked}
        for doc_id, found in lists:
            score = 0
            for term in asked & set(found):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m, tf = 50 + 50 * len(found) * n_docs // n_terms, found.count(term)
                score += w * (10**9 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        rows += [
            (item, rank, None if none else doc_id, -score)
            for rank, (score, none, doc_id) in enumerate(sorted(scored)[:k], 1)
        ]
    return sorted(rows, key=str)


def ask(spark, docs, items, k=5, width=max_sketch.WIDTH, **bounds):
    index = settle(build_index(docs, width), "index")
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in search(docs, index, asked, k, width=width, **bounds).collect()), key=str)


def corpus(rng, size):
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)] + ["Éa", "漢字", "X1"]
    draw = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(("", ".", "-")) for _ in range(n))
    docs = [(k, draw(rng.choice((3, 20, 60, 400)))) for k in range(size)]
    docs += [(1000 + k, docs[0][1]) for k in range(40)] + [(3, docs[3][1]), (None, docs[1][1])]
    return docs, [(k, draw(rng.randint(1, 25))) for k in range(14)] + [(3, docs[0][1])]


@pytest.mark.parametrize("width", [1 << 20, 32])
def test_equal_to_brute_force(spark, table, width):
    """Also with so few coordinates that most bounds are far too high."""
    rng = random.Random(width)
    docs, items = corpus(rng, 150)
    found = ask(spark, table(docs), items, width=width)
    assert found == brute_force(docs, items, 5)


def test_blocks_do_not_matter(spark, table):
    docs, items = corpus(random.Random(2), 60)
    expected = brute_force(docs, items, 7)
    assert ask(spark, table(docs), items, 7, most_items=4) == expected
    assert ask(spark, table(docs), items, 7, most_terms=30) == expected


def test_large_groups_are_cut_in_parts(spark, monkeypatch):
    monkeypatch.setattr(max_sketch, "GROUP_ROWS", 100)
    rows = [(k % 3, (k * 7919) % 1000) for k in range(3000)]
    df = spark.createDataFrame(rows, "g int, v int")
    from pyspark.sql import functions as F

    found = max_sketch.best_rows(df, "g", [F.desc("v")], 4, "place").collect()
    expected = [(g, v, p) for g in range(3) for p, v in enumerate(sorted((v for h, v in rows if h == g))[::-1][:4], 1)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_bounds_hold_and_are_near(spark, table):
    """No score is above its bound, and most are equal to it."""
    docs, items = corpus(random.Random(3), 100)
    batch = build_index(table(docs)).toArrow().combine_chunks().to_batches()[0]
    queries = Queries(list(range(len(items))), [i for i, _ in items])
    queries.found = [sorted({w.encode() for w in words(t)}) for _, t in items]
    queries.n_docs, queries.n_terms = len(docs), sum(len(words(t)) for _, t in docs)
    queries.weights = {t: 100 + len(t) for found in queries.found for t in found}
    scorer = Scorer(queries)
    factors = scorer.factors(batch)
    bounds = scorer.bounds(batch, factors)
    from collections import Counter

    texts = [Counter(w.encode() for w in words(t)) for _, t in docs]
    exact = np.array(
        [[scorer.score(q, c, int(f)) for c, f in zip(texts, factors)] for q in range(len(queries))]
    )
    assert (bounds >= exact).all() and (bounds == exact).mean() > 0.9


def test_odd_rows(spark, table, prose):
    docs = [*ODD, (8, prose(30_000, 4)), (9, ""), (10, "one " * 200), (11, "ONE")]
    items = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "ümlaut 漢字 alike"), (5, prose(3_000, 4)), (6, "unknown-term")]
    assert ask(spark, table(docs, extra=True), items, 50) == brute_force(docs, items, 50)
    assert ask(spark, table([]), items) == []
    assert ask(spark, table([(1, None), (2, " .")]), items) == []
    assert ask(spark, table(docs), []) == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    read = lambda name, key: [(r[key], r["text"]) for r in spark.read.parquet(f"{sf}/{name}.parquet").collect()]
    expected = brute_force(read("documents", "doc_id"), read("benchmark", "item_id"), 50)
    found = op12_ranked_search(spark, sf)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected
