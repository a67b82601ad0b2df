"""N-gram Jaccard join by vertical partitioning.

A text is the set of its word n-grams. One order of all n-grams is cut into fragments, so each set is
cut into segments. Fragments are worked on apart: each counts what sets share inside it, and the counts
are summed, for each set or for each pair of sets.

1. Equal sets are one node from the start.
2. Fragments of the smallest hashes of each set (as many as two similar sets must share some of) count
   how many n-grams of each node another node has too. Nodes that share too few can link with nothing.
3. For the rest, fragments of all hashes give the n-grams that are shared at all, and nodes that share
   fewer than the similarity needs are left out.
4. The remaining sets are ordered by how rare an n-gram is. Each n-gram of a set's prefix links the set
   to one node of that n-gram, the one with the fewest n-grams of its own; the partial overlaps of these
   pairs are summed over fragments. This joins a group of m near copies by about m pairs, not m * m.
5. Pairs across the components found are counted likewise, if they share an n-gram of both prefixes from
   which on both sets have enough n-grams that others have too.

No pair of similar sets is missed: it shares an n-gram of both prefixes, so it is either inside one
component after step 4 or counted in step 5. Nodes and n-grams are 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import HOT_ROWS, documents, hot_join, pieces
from sparkprep.llm.components import components
from sparkprep.llm.hashing import shingle_sets
from sparkprep.workspace import release, settle, settle_alone

MANY = np.uint64(0)
"""Owner of an n-gram that several nodes of one chunk have."""


def _node(shingles: np.ndarray) -> int:
    """A set's 64-bit name, signed; never 0."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True) or 1


def required(n: int, percent: int) -> int:
    """The least overlap with a set of ``n`` of any set similar to it."""
    return -(-n * percent // 100)


def slack(n: int) -> int:
    """How many more than one n-gram the longer prefix of step 2 lets similar sets share."""
    return n // 10 + 1


def prefix_size(n: int, percent: int, shared: int = 1) -> int:
    """So many first n-grams of similar sets have at least ``shared`` in common."""
    return min(n, n - required(n, percent) + shared)


def least_credit(n: int, percent: int) -> int:
    """What step 2 must find for a set of ``n``: the slack of the smallest set similar to it."""
    return slack(required(n, percent))


def node_table(docs: DataFrame, text: str, k: int, chunk_bytes: int) -> DataFrame:
    """Each row's node, its set's size and a hash of its text."""
    schema = "doc_id bigint, text_hash bigint, n int, node bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", chunk_bytes):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            sets = shingle_sets(texts, k)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_hash": batch.column("text_hash"),
                    "n": pa.array([len(s) for s in sets], pa.int32()),
                    "node": pa.array([_node(s) for s in sets], pa.int64()),
                }
            )

    given = docs.select(
        "doc_id",
        F.xxhash64(F.col(text)).alias("text_hash"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return given.mapInArrow(run, schema)


def _chunk_postings(
    sets: list[np.ndarray], fragments: int, share: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of a chunk, each with its owner (or none if several), the fragment
    borders, and the n-grams that several sets have with the sets that have them.

    ``share`` is how much of the order, from its beginning, the sets' n-grams mostly lie in."""
    hashes = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[order], owners[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(hashes)))
    shared = np.repeat(counts > 1, counts)
    width = -(-int((1 << 64) * share) // fragments)
    borders = np.array([min(f * width, (1 << 64) - 1) for f in range(1, fragments)], np.uint64)
    cuts = np.searchsorted(hashes[first], borders)
    single = np.where(counts > 1, -1, owners[first])
    return hashes[first], single, np.concatenate(([0], cuts, [len(first)])), hashes[shared], owners[shared]


def _scatter(k: int, percent: int, fragments: int, chunk_bytes: int, prefix_only: bool):
    """Rows for each fragment: its n-grams in a chunk with their owners, and what the chunk settles.

    An n-gram that several nodes of the chunk have is known to be shared: those nodes are told so at
    once (``kind`` 1), and one posting stands for all of them. So a very common n-gram has one posting
    for each chunk, not one for each text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", chunk_bytes):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            sets, nodes, seen = [], [], set()
            for s in shingle_sets(texts, k):
                node = _node(s)
                if len(s) and node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    size = prefix_size(len(s), percent, slack(len(s))) if prefix_only else len(s)
                    sets.append(s[:size])
            names = np.array(nodes, np.int64).view(np.uint64)
            hashes, single, cuts, shared, owners = _chunk_postings(sets, fragments, 0.4 if prefix_only else 1.0)
            named = np.append(names, MANY)[single]
            rows = []
            for f, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                if b > a:
                    rows.append((f, 0, hashes[a:b].tobytes(), named[a:b].tobytes()))
            if len(owners):
                home = int(names[owners[0]] % np.uint64(fragments))
                rows.append((home, 1, shared.tobytes(), names[owners].tobytes()))
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int32()),
                        pa.array(columns[1], pa.int32()),
                        pa.array(columns[2], pa.binary()),
                        pa.array(columns[3], pa.binary()),
                    ],
                    ["fragment", "kind", "hashes", "owners"],
                )

    return run


_SCATTERED = "fragment int, kind int, hashes binary, owners binary"


def _fragment_shared(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (n-gram, node) of one fragment whose n-gram another node has too."""
    joined = lambda part: np.frombuffer(b"".join(part), np.uint64)
    told, apart = rows[rows["kind"] == 1], rows[rows["kind"] == 0]
    hashes, owners = joined(apart["hashes"]), joined(apart["owners"])
    order = np.lexsort((owners, hashes))
    hashes, owners = hashes[order], owners[order]
    if len(hashes):
        first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        counts = np.diff(np.append(first, len(hashes)))
        several = np.minimum.reduceat(owners, first) != np.maximum.reduceat(owners, first)
        keep = np.repeat(several, counts) & (owners != MANY)
        keep[1:] &= (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        hashes, owners = hashes[keep], owners[keep]
    return (
        np.concatenate([hashes, joined(told["hashes"])]),
        np.concatenate([owners, joined(told["owners"])]),
    )


def _credits(parts: int):
    """How many shared n-grams of a fragment each node has, in one row for each part of the nodes."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        _, owners = _fragment_shared(rows)
        nodes, credit = np.unique(owners, return_counts=True)
        home = nodes % np.uint64(parts)
        order = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[order], np.arange(parts + 1)).tolist()
        out = [(h, order[a:b]) for h, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return pd.DataFrame(
            {
                "home": np.array([h for h, _ in out], np.int32),
                "nodes": [nodes[p].tobytes() for _, p in out],
                "credits": [credit[p].astype("<i8").tobytes() for _, p in out],
            }
        )

    return run


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    """The credits of a part's nodes, summed over fragments."""
    nodes, at = np.unique(np.frombuffer(b"".join(rows["nodes"]), "<i8"), return_inverse=True)
    total = np.zeros(len(nodes), np.int64)
    np.add.at(total, at, np.frombuffer(b"".join(rows["credits"]), "<i8"))
    return pd.DataFrame({"node": nodes, "credit": total})


def _segments(rows: pd.DataFrame) -> pd.DataFrame:
    hashes, owners = _fragment_shared(rows)
    order = np.argsort(owners, kind="stable")
    return pd.DataFrame({"node": owners[order].view(np.int64), "hash": hashes[order].view(np.int64)})


def _fragments(size_bytes: int, fragment_bytes: int) -> int:
    return max(1, -(-size_bytes // fragment_bytes))


def _required_column(n: str, percent: int) -> Column:
    return F.ceil(F.col(n) * percent / F.lit(100)).cast("int")


def partial_overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """What the sets of each pair ``a``, ``b`` share in each fragment in which both have a segment.

    Many pairs may have the same ``a``. Its segments are repeated for every ``HOT_ROWS`` of them.
    """
    counts = settle(pairs.groupBy("a").agg(F.count("*").alias("rows")), "pair-counts")
    counts = counts.withColumn("lanes", F.ceil(F.col("rows") / F.lit(HOT_ROWS)).cast("int"))
    laned = hot_join(pairs, counts, ["a"], "rows").select(
        "a", "b", F.pmod(F.xxhash64("b"), "lanes").cast("int").alias("lane")
    )

    def side(name: str) -> list[Column]:
        return [F.col(c).alias(f"{c}_{name}") for c in ("hashes", "n", "shared")]

    left = segments.join(counts.select(F.col("a").alias("node"), "lanes"), "node").select(
        F.col("node").alias("a"), "fragment", *side("a"),
        F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"),
    )
    right = segments.select(F.col("node").alias("b"), "fragment", *side("b"))
    both = laned.join(right, "b").join(left, ["a", "lane", "fragment"])
    return both.select(
        "a", "b", "n_a", "n_b",
        F.size(F.array_intersect("hashes_a", "hashes_b")).cast("long").alias("overlap"),
        F.least(
            F.col("shared_a") - F.size("hashes_a"), F.col("shared_b") - F.size("hashes_b")
        ).alias("beyond"),
    )


def _links(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar: overlaps of the rare n-grams first, then those of other fragments.

    The rare fragment settles most pairs: what they share there, and all that is left of the smaller
    set, is too little.
    """
    needed = lambda overlap: (100 + percent) * overlap >= percent * (F.col("n_a") + F.col("n_b"))
    head = partial_overlaps(pairs, segments.where("fragment = 0"))
    head = settle(head.where(needed(F.col("overlap") + F.col("beyond"))), "pair-heads")
    rest = partial_overlaps(head.select("a", "b"), segments.where("fragment > 0"))
    parts = head.select("a", "b", "n_a", "n_b", "overlap").unionByName(
        rest.select("a", "b", "n_a", "n_b", "overlap")
    )
    summed = parts.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return summed.where(needed(F.col("overlap")))


def similar_groups(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    k: int = 5,
    percent: int = 75,
    fragment_bytes: int = 8 << 20,
    chunk_bytes: int = 1 << 20,
    overlap_fragments: int = 4,
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``; and
    ``text_hash``, and ``stays``, true for the first row of each component (by id, then text hash).

    Sets link when their Jaccard similarity is ``percent`` or more; ``component_id`` is the smallest
    ``doc_id`` that links lead to. Texts without words, NULL ones included, are linked with nothing
    and keep their own id. Rows with equal texts are in one component; NULL ids count in no minimum.
    ``fragment_bytes`` is what a task holds of a fragment; ``chunk_bytes`` of text are combined before
    the shuffle.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    table = settle(node_table(docs, "text", k, chunk_bytes), "shingle-nodes")
    classes = table.where("n > 0").groupBy("node", "n").agg(
        F.count("*").alias("rows"),
        F.min("doc_id").alias("least"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("at"),
    )
    classes = settle(classes, "shingle-classes")
    sizes = classes.agg(F.sum("n"), F.count("*")).first()
    postings = int(sizes[0] or 0) * 16

    given = docs.where(F.col("text").isNotNull())
    fragments = _fragments(postings * 35 // 100, fragment_bytes)
    first = given.select("text").mapInArrow(
        _scatter(k, percent, fragments, chunk_bytes, True), _SCATTERED
    )
    credits = first.groupBy("fragment").applyInPandas(
        _credits(fragments), "home int, nodes binary, credits binary"
    )
    credits = credits.groupBy("home").applyInPandas(_summed, "node bigint, credit bigint")
    smaller = _required_column("n", percent)
    enough = F.col("credit") >= F.floor(smaller / F.lit(10)) + 1
    # A class that others' copies also count for is only kept too readily, never lost.
    left = credits.join(classes, "node").where(enough).select("node", "n", "at")
    left = settle(left, "shingle-left")
    chosen = left.select(F.col("at.doc_id").alias("at_id"), F.col("at.text_hash").alias("at_hash"))
    texts = given.join(
        chosen, F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.xxhash64("text") == F.col("at_hash"))
    ).select("text")
    remaining = int(left.agg(F.sum("n")).first()[0] or 0) * 16
    second = texts.mapInArrow(
        _scatter(k, percent, _fragments(remaining, fragment_bytes), chunk_bytes, False), _SCATTERED
    )
    shared = second.groupBy("fragment").applyInPandas(_segments, "node bigint, hash bigint")
    shared = shared.groupBy("node").agg(F.collect_set("hash").alias("hashes"))
    finalists = shared.join(left.select("node", "n"), "node").where(
        F.size("hashes") >= smaller
    )
    finalists = settle(finalists, "shingle-finalists")
    release(left)

    # The order of all n-grams: rare ones first, then by hash.
    single = settle(finalists.select("node", "n", F.explode("hashes").alias("hash")), "shingle-postings")
    release(finalists)
    rarity = single.groupBy("hash").agg(F.count("*").alias("df")).where("df > 1")
    rarity = settle(rarity.withColumn("rows", F.col("df")), "shingle-rarity")
    ranked = hot_join(single, rarity, ["hash"], "rows").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "hash"))).alias("ordered")
    )
    ranked = settle(ranked.where(F.size("ordered") >= smaller), "shingle-ranked")
    release(single, rarity)
    alone = F.col("n") - F.size("ordered")  # n-grams nobody else has come first in the order
    length = F.greatest(F.col("n") - smaller + 1 - alone, F.lit(0))
    # against larger sets a shorter prefix will do: the overlap must be larger too
    short = F.col("n") - F.ceil(F.col("n") * 2 * percent / F.lit(100 + percent)) + 1
    prefix = ranked.select(
        "node", "n", alone.alias("alone"), F.posexplode(F.slice("ordered", 1, length)).alias("place", "gram")
    ).select(
        "node", "n", "alone", F.col("gram.hash").alias("hash"),
        (F.col("place") + F.col("alone") + 1 > short).alias("late"),
        (F.col("n") - F.col("alone") - F.col("place")).alias("most"),
    )
    prefix = settle(prefix, "shingle-prefix")

    place = lambda x: x["df"].cast("double") + x["hash"].cast("double") / F.lit(2.0**64)
    # the rare half is one fragment, the rest are even
    steps = [0.5 + 0.5 * i / overlap_fragments for i in range(overlap_fragments)]
    grams = ranked.select(F.explode("ordered").alias("gram"))
    cuts = grams.agg(F.percentile_approx(place(F.col("gram")), steps, 1000)).first()[0] or []
    borders = [-math.inf, *cuts, math.inf]

    def inside(f: int) -> Column:
        low, high = F.lit(borders[f]), F.lit(borders[f + 1])
        held = F.filter("ordered", lambda x: (place(x) > low) & (place(x) <= high))
        return F.struct(F.lit(f).alias("fragment"), F.transform(held, lambda x: x["hash"]).alias("hashes"))

    segments = ranked.select(
        "node", "n", F.size("ordered").alias("shared"),
        F.explode(F.array(*map(inside, range(len(borders) - 1)))).alias("s"),
    ).select("node", "n", "shared", "s.fragment", "s.hashes")
    # every set has its rare fragment, even an empty one
    segments = segments.where((F.size("hashes") > 0) | (F.col("fragment") == 0))
    segments = settle(segments, "shingle-segments")
    release(ranked)

    # The text that copies were made from has the fewest n-grams of its own, and is near to all of them.
    lead = F.min(F.struct("alone", "node", "n", "most"))
    leads = prefix.groupBy("hash").agg(lead.alias("lead"), F.count("*").alias("rows"))
    leads = leads.select(
        "hash", "rows", F.col("lead.node").alias("a"), F.col("lead.n").alias("n_a"), F.col("lead.most").alias("most_a")
    )

    def possible(a: str, b: str) -> Column:
        """Whether what both sets have from this n-gram on is enough for the overlap their sizes need.

        That must hold at the first n-gram that similar sets share, so no such pair is lost.
        """
        most = F.least(f"most_{a}", f"most_{b}")
        return (100 + percent) * most >= percent * (F.col(f"n_{a}") + F.col(f"n_{b}"))

    leads = settle(leads.where("rows > 1"), "shingle-leads")
    members = prefix.select("hash", *(F.col(c).alias(x) for c, x in (("node", "b"), ("n", "n_b"), ("most", "most_b"))))
    stars = hot_join(members, leads, ["hash"], "rows").where(F.col("a") != F.col("b"))
    stars = settle(stars.where(possible("a", "b")).select("a", "b").distinct(), "shingle-stars")
    release(leads)
    spark = docs.sparkSession
    links = settle_alone(spark, lambda: _links(stars, segments, percent).select("a", "b"), "shingle-links")
    release(stars)

    roots = settle_alone(spark, lambda: components(links), "shingle-roots")
    rooted = prefix.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = settle(rooted, "shingle-rooted")
    release(prefix, roots)
    across = rooted.groupBy("hash").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("rows")
    )
    across = settle(across.where("low < high").select("hash", "rows"), "shingle-across")
    open_ = settle(hot_join(rooted, across, ["hash"], "rows"), "shingle-open")
    release(rooted, across)
    names = ("node", "n", "root", "most")
    one = open_.select("hash", *(F.col(c).alias(f"{c}_a") for c in names))
    two = open_.where(~F.col("late")).select("hash", *(F.col(c).alias(f"{c}_b") for c in names))
    # b is the smaller set of the two
    below = (F.col("n_b") < F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("node_b") < F.col("node_a")))
    pairs = one.join(two, "hash").where((F.col("root_a") != F.col("root_b")) & below & possible("a", "b"))
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    pairs = settle(pairs.distinct(), "shingle-pairs")
    release(open_)
    more = settle_alone(spark, lambda: _links(pairs, segments, percent).select("a", "b"), "shingle-more")
    release(pairs, segments)
    roots = settle_alone(spark, lambda: components(links.unionByName(more)), "shingle-roots")
    release(links, more)

    named = settle(
        classes.select("node", "rows", "least", "at").join(roots, "node", "left").withColumn(
            "root", F.coalesce("root", "node")
        ),
        "shingle-named",
    )
    release(classes, roots)
    least = named.groupBy("root").agg(
        F.min("least").alias("component_id"), F.min("at").alias("first"), F.count("*").alias("n")
    )
    least = settle(least, "shingle-least")
    found = hot_join(named, least, ["root"], "n").select("node", "rows", "component_id", "first")
    found = settle(found, "shingle-components")
    release(named, least)
    named = found
    linked = hot_join(table.where("n > 0"), named, ["node"], "rows")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    linked = linked.withColumn("stays", stays)
    empty = table.where("n = 0").withColumn("component_id", F.col("doc_id")).withColumn("stays", F.lit(True))
    columns = ("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "text_hash", "stays")
    return linked.select(*columns).unionByName(empty.select(*columns))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of 5-word shingles and its component of links."""
    found = similar_groups(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")
