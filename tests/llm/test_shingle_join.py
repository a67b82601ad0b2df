import random
import re
from collections import Counter

import numpy as np
import pytest

from sparkprep.llm.components import components
from sparkprep.llm.hashing import shingle_sets
from sparkprep.llm.shingle_join import least_credit, prefix_size, required, similar_groups, slack
from cases import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, percent=75):
    """(id, set size, smallest id of the component) of each row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return Counter((i, len(s), least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def found(df, **options):
    rows = similar_groups(df, **options).collect()
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def families(prose, seed):
    """Texts in families of copies with some words changed, from hardly any to too many."""
    rng = random.Random(seed)
    rows = []
    for family in range(6):
        base = prose(rng.choice([12, 40, 150]), seed * 100 + family).split(" ")
        for copy in range(rng.choice([2, 5, 12])):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 18))):
                words[rng.randrange(len(words))] = rng.choice(("uno", "due", "tre", str(copy)))
            rows.append((rng.randrange(10**6), " ".join(words).title() if copy % 2 else " ".join(words)))
    return rows + [(10**7 + k, prose(60, 7000 + seed * 50 + k)) for k in range(10)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_components_as_all_pairs(table, prose, seed):
    rows = families(prose, seed)
    # many small chunks and fragments, so that every path across them is taken
    options = {"chunk_bytes": 3000, "fragment_bytes": 2000, "overlap_fragments": 3}
    assert found(table(rows).repartition(4), **options) == brute(rows)


def test_chain_of_links(table):
    """Neighbours are similar, the ends are not; all are one component."""
    words = [f"w{k}" for k in range(200)]
    rows = [(50 - k, " ".join(words[4 * k : 4 * k + 100])) for k in range(20)]
    expected = brute(rows)
    assert {c for _, _, c in expected} == {31}
    assert found(table(rows)) == expected


def test_odd_rows(table):
    rows = [*ODD, (7, "ALIKE"), (8, "one two three four five"), (9, "one two three four five six")]
    assert found(table(rows, extra=True)) == brute(rows)
    assert similar_groups(table([])).count() == 0


def test_one_row_stays(table, prose):
    rows = families(prose, 4) + [(5, "alike"), (5, "alike"), (None, "alike"), (None, "apart"), (3, "")]
    stays = [r for r in similar_groups(table(rows)).collect() if r.stays]
    kept = {(r.doc_id, r.text_hash) for r in stays}
    groups = {c for i, _, c in brute(rows) if c is not None}
    assert {i for i, _ in kept if i is not None} == groups
    assert sum(i is None for i, _ in kept) == 1


def test_prefixes_suffice():
    """Any two sets that are similar share as much of their prefixes as step 2 asks for."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = rng.choice(1000, n, replace=False)
        b = np.unique(np.concatenate([a[: int(n * rng.uniform(0.7, 1))], rng.integers(1000, 2000, n // 5)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        heads = [np.sort(s)[: prefix_size(len(s), 75, slack(len(s)))] for s in (a, b)]
        shared = len(np.intersect1d(*heads))
        assert shared >= least_credit(len(a), 75) and shared >= least_credit(len(b), 75)
        assert both >= required(len(a), 75)


def test_short_and_empty_texts_have_sets():
    sets = shingle_sets([b"", b" ", b"a b", b"a b c d e f", b"A  b\n"], 5)
    assert [len(s) for s in sets] == [0, 0, 1, 2, 1]
    assert sets[2][0] == sets[4][0]


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (4, 9), (7, 7), (20, 3)] + [(100, k) for k in range(101, 160)]
    rows = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    root = dict(tuple(r) for r in rows)
    assert len(rows) == len(root)
    expected = {1: 1, 2: 1, 3: 1, 20: 1, 4: 4, 5: 4, 9: 4} | {k: 100 for k in range(100, 160)}
    assert root == expected
