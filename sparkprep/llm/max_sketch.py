"""Ranked lexical search with hashed max-sketches.

A document's sketch keeps, for each of a fixed number of hashed coordinates, the greatest number of
times that any of its terms there occurs. A term's impact grows with its occurrences, so the sketch
gives the greatest impact of a coordinate, whatever the corpus statistics are, and the weighted impacts
of a query's coordinates add up to an upper bound of the document's score. The index holds the
sketches of all documents and is written once.

A block of queries is answered by descending bounds. A pass over the sketches finds the documents of the
greatest bounds for each query. These are scored exactly, which gives a score that the k-th best has at
least. If documents with lower bounds could still reach it, a larger wave of them raises that score
first. The last pass finds all documents whose bound reaches the score, and only these are scored, so
no document is left out that could be among the best. Texts are read again for the documents found,
and tasks hand on their best ``k`` only.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkprep.llm.common import documents, pieces
from sparkprep.llm.hashing import LOWER
from sparkprep.workspace import new_path, scratch, settle

WIDTH = 1 << 20
"""Coordinates of a sketch. Only those with a term are kept, so more of them cost no room and make the
bounds of long texts nearer."""

FIRST_WAVE, NEXT_WAVE, MOST_WAVES = 4, 8, 3
"""The first wave scores so many times ``k`` documents of a query, and each next one so many times more."""

SCALE = 1_000_000_000
"""Fixed value: impacts are whole numbers of this scale, divided by ``1000 * tf + 20 * m``."""

# A-Z to a-z; ASCII characters that are neither letters nor digits part the terms.
_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in LOWER
)

BLOCK_ITEMS, BLOCK_TERMS = 512, 50_000
"""Queries, and distinct terms of queries, that a pass answers at once; a single query may have more."""

SMALL_ROWS, SMALL_PAIRS = 200_000, 2_000_000
"""Documents, and queries of them all together, that are broadcast: some 20 MB."""

GROUP_ROWS = 100_000
"""Rows of one query that are sorted in one group; more are first cut down in several."""


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factors(lengths: list[int], n_docs: int, n_terms: int) -> list[int]:
    return [50 + 50 * n * n_docs // n_terms for n in lengths]


def build_index(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n, coordinates, peaks)`` of every row: its number of terms and its sketch.

    ``coordinates`` are those with a term, ascending (32-bit), ``peaks`` the greatest number of
    occurrences in each (32-bit). NULL and empty texts have none.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4 << 20):
            lengths, places, peaks = [], [], []
            for text in batch.column("text").to_pylist():
                counts = Counter(terms(text or b""))
                lengths.append(counts.total())
                where = np.fromiter((crc32(t) for t in counts), np.uint32, len(counts)) % width
                times = np.fromiter(counts.values(), np.uint32, len(counts))
                order = np.lexsort((times, where))
                where, times = where[order], times[order]
                last = np.append(where[1:] != where[:-1], True)[: len(where)]  # the greatest of each
                places.append(where[last].astype("<u4").tobytes())
                peaks.append(times[last].astype("<u4").tobytes())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n": pa.array(lengths, pa.int64()),
                    "coordinates": pa.array(places, pa.binary()),
                    "peaks": pa.array(peaks, pa.binary()),
                }
            )

    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return given.mapInArrow(sketch, "doc_id bigint, n bigint, coordinates binary, peaks binary")


@dataclass
class Queries:
    """A block of queries with what the corpus says about their terms."""

    numbers: list[int] = field(default_factory=list)
    ids: list[Any] = field(default_factory=list)
    found: list[list[bytes]] = field(default_factory=list)
    """Distinct terms of each query."""
    weights: dict[bytes, int] = field(default_factory=dict)
    n_docs: int = 0
    n_terms: int = 0
    width: int = WIDTH
    """Coordinates of the sketches to look up."""

    def __len__(self) -> int:
        return len(self.ids)


def query_blocks(items: DataFrame, item: str, most_items: int, most_terms: int) -> Iterator[Queries]:
    """Queries in blocks of bounded size; the driver holds one block at a time."""
    block, n_terms = Queries(), 0
    rows = items.select(F.col(item), F.col("text").cast("binary").alias("text")).toLocalIterator()
    for number, row in enumerate(rows):
        found = sorted(set(terms(row["text"] or b"")))
        if len(block) and (len(block) >= most_items or n_terms + len(found) > most_terms):
            yield block
            block, n_terms = Queries(), 0
        if found:  # without terms there is no score above 0
            block.numbers.append(number)
            block.ids.append(row[item])
            block.found.append(found)
            n_terms += len(found)
    if len(block):
        yield block


def document_frequencies(docs: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """How many documents hold each of the wanted terms; counted in the tasks, then summed by term."""
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(wanted))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in pieces(batches, "text", 4 << 20):
            for text in batch.column("text").to_pylist():
                counts.update(shared.value.intersection(terms(text or b"")))
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array(list(counts), pa.binary()), "df": pa.array(counts.values(), pa.int64())}
        )

    tallied = docs.select(F.col("text").cast("binary")).mapInArrow(tally, "term binary, df bigint")
    rows = tallied.groupBy("term").agg(F.sum("df").alias("df")).collect()  # as many as query terms
    return {bytes(r["term"]): r["df"] for r in rows}


class Scorer:
    """Bounds and exact scores of batches of index rows for a block of queries."""

    def __init__(self, queries: Queries):
        self.queries = queries
        self.places = np.full(queries.width, -1, np.int32)  # rows of the batch's table by coordinate
        used: dict[int, int] = {}
        self.lookups = []  # of each query: rows of the table, and their weights
        for found in queries.found:
            summed: Counter = Counter()
            for term in found:
                if term in queries.weights:  # the others are in no document
                    summed[crc32(term) % queries.width] += queries.weights[term]
            rows = [used.setdefault(c, len(used)) for c in summed]
            self.lookups.append((np.array(rows, np.int64), np.array(list(summed.values()), np.int64)))
        for coordinate, row in used.items():
            self.places[coordinate] = row
        self.width = len(used)
        self.rows = max(1, (4 << 20) // max(1, self.width, len(queries)))

    def slices(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start in range(0, batch.num_rows, self.rows):
            yield batch.slice(start, self.rows)

    def factors(self, batch: pa.RecordBatch) -> np.ndarray:
        given = batch.column("n").to_pylist()
        return np.array(length_factors(given, self.queries.n_docs, self.queries.n_terms), np.int64)

    def bounds(self, batch: pa.RecordBatch, factors: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, a row for each query and a column for each document."""
        held = batch.column("coordinates").to_pylist()
        where = np.frombuffer(b"".join(held), "<u4")
        times = np.frombuffer(b"".join(batch.column("peaks").to_pylist()), "<u4")
        docs = np.repeat(np.arange(len(held)), [len(h) // 4 for h in held])
        rows = self.places[where]
        known = rows >= 0
        rows, times, docs = rows[known], times[known].astype(np.int64), docs[known]
        impacts = np.zeros((self.width, len(held)), np.int64)
        impacts[rows, docs] = SCALE * times // (1000 * times + 20 * factors[docs])
        bounds = np.zeros((len(self.queries), len(held)), np.int64)
        for k, (rows, weights) in enumerate(self.lookups):
            if len(rows):
                bounds[k] = weights @ impacts[rows]
        return bounds

    def score(self, query: int, counts: Counter, factor: int) -> int:
        """Exact score of a document with the given term counts."""
        weights, total = self.queries.weights, 0
        for term in self.queries.found[query]:
            times = counts.get(term)
            if times:
                total += weights[term] * (SCALE * times // (1000 * times + 20 * factor))
        return total


def _order(hit: tuple) -> tuple:
    score, doc_id = hit
    return -score, doc_id is None, doc_id or 0


class _Best:
    """The best ``k`` hits of each query that a task has met."""

    def __init__(self, queries: int, k: int):
        self.k, self.hits = k, [[] for _ in range(queries)]
        self.least = [1] * queries  # a score that a new hit needs

    def add(self, query: int, score: int, doc_id: int | None) -> None:
        hits = self.hits[query]
        hits.append((score, doc_id))
        if len(hits) >= 2 * self.k:
            self.cut(query)

    def cut(self, query: int) -> None:
        hits = sorted(self.hits[query], key=_order)[: self.k]
        self.hits[query] = hits
        if len(hits) == self.k:
            self.least[query] = max(self.least[query], hits[-1][0])


def _leading(index: DataFrame, queries: Queries, k: int) -> DataFrame:
    """``(query, doc_id, bound, place)`` of the ``k`` documents with the greatest bounds of each query."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        n = len(shared.value)
        top, ids, named = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64), np.zeros((n, k), bool)
        for whole in batches:
            for batch in scorer.slices(whole):
                bounds = scorer.bounds(batch, scorer.factors(batch))
                doc_id = batch.column("doc_id")
                held = [
                    (top, bounds),
                    (ids, np.broadcast_to(doc_id.fill_null(0).to_numpy(), bounds.shape)),
                    (named, np.broadcast_to(doc_id.is_valid().to_numpy(zero_copy_only=False), bounds.shape)),
                ]
                both = [np.concatenate(pair, axis=1) for pair in held]
                kept = np.argpartition(both[0], both[0].shape[1] - k, axis=1)[:, -k:]
                top, ids, named = (np.take_along_axis(x, kept, axis=1) for x in both)
        query, _ = np.nonzero(top)
        has = top > 0
        yield pa.RecordBatch.from_pydict(
            {
                "query": pa.array(query, pa.int32()),
                "doc_id": pa.array(ids[has], pa.int64(), mask=~named[has]),
                "bound": pa.array(top[has], pa.int64()),
            }
        )

    found = index.mapInArrow(best, "query int, doc_id bigint, bound bigint")
    return best_rows(settle(found, "bounds"), "query", [F.desc("bound")], k, "place")


def _reaching(index: DataFrame, queries: Queries, least: list[int]) -> DataFrame:
    """``(query, doc_id)`` of all documents whose bound is the query's ``least`` or more."""
    shared = index.sparkSession.sparkContext.broadcast((queries, np.array(least, np.int64)))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least = shared.value
        scorer = Scorer(queries)
        for whole in batches:
            for batch in scorer.slices(whole):
                bounds = scorer.bounds(batch, scorer.factors(batch))
                query, place = np.nonzero(bounds >= least[:, None])
                yield pa.RecordBatch.from_pydict(
                    {
                        "query": pa.array(query, pa.int32()),
                        "doc_id": batch.column("doc_id").take(pa.array(place)),
                    }
                )

    return index.mapInArrow(reach, "query int, doc_id bigint")


def _scored(docs: DataFrame, pairs: DataFrame, queries: Queries, k: int) -> DataFrame:
    """``(number, query, doc_id, score)`` of pairs of queries and documents; only scores above 0.

    Every row of a document's id is scored. Each task gives its best ``k`` of a query at most. The pairs are
    gathered by document; so many as ``SMALL_ROWS`` allows are broadcast, more meet the texts in a
    shuffle, where each id has one row on the pairs' side.
    """
    by_document = pairs.distinct().groupBy("doc_id").agg(F.collect_list("query").alias("queries"))
    by_document = settle(by_document.withColumnRenamed("doc_id", "_doc_id"), "wanted")
    size = by_document.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("queries")).alias("pairs")).first()
    if size["n"] <= SMALL_ROWS and (size["pairs"] or 0) <= SMALL_PAIRS:
        by_document = F.broadcast(by_document)
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        scorer, best = Scorer(queries), _Best(len(queries), k)
        for batch in pieces(batches, "text", 4 << 20):
            ids, asked = batch.column("doc_id").to_pylist(), batch.column("queries").to_pylist()
            for doc_id, text, wanted in zip(ids, batch.column("text").to_pylist(), asked):
                found = terms(text or b"")
                if not found:
                    continue
                counts = Counter(found)
                (factor,) = length_factors([len(found)], queries.n_docs, queries.n_terms)
                for query in wanted:
                    total = scorer.score(query, counts, factor)
                    if total >= best.least[query]:
                        best.add(query, total, doc_id)
        rows = []
        for query, number in enumerate(queries.numbers):
            best.cut(query)
            rows += [(number, query, doc_id, total) for total, doc_id in best.hits[query]]
        kinds = {"number": pa.int64(), "query": pa.int32(), "doc_id": pa.int64(), "score": pa.int64()}
        yield pa.RecordBatch.from_pydict(
            {c: pa.array([r[i] for r in rows], kind) for i, (c, kind) in enumerate(kinds.items())}
        )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    met = texts.join(by_document, F.col("doc_id").eqNullSafe(F.col("_doc_id"))).drop("_doc_id")
    return met.mapInArrow(score, "number bigint, query int, doc_id bigint, score bigint")


def best_rows(df: DataFrame, by: str, order: list, k: int, name: str) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, numbered from 1.

    Groups of many rows are cut down in parts first, so that none is sorted whole in one task. ``df``
    is a settled table.
    """
    largest = df.groupBy(by).count().agg(F.max("count")).first()[0] or 0
    if largest > GROUP_ROWS:
        parts = -(-largest // GROUP_ROWS)
        others = [F.col(c) for c in df.columns if c != by]
        part = F.pmod(F.xxhash64(*others), F.lit(parts)).alias("_part")
        window = Window.partitionBy(by, "_part").orderBy(*order)
        df = df.select("*", part).withColumn(name, F.row_number().over(window))
        df = df.where(F.col(name) <= k).drop("_part", name)
    window = Window.partitionBy(by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def search(
    docs: DataFrame,
    index: DataFrame,
    items: DataFrame,
    k: int = 50,
    item: str = "item_id",
    most_items: int = BLOCK_ITEMS,
    most_terms: int = BLOCK_TERMS,
    width: int = WIDTH,
) -> DataFrame:
    """``(item, rank, doc_id, score)``: the best ``k`` documents of each query with a score above 0.

    ``index`` is a table written from :func:`build_index` of ``docs`` with the same ``width``; ``items``
    has the queries in ``text``. Equal scores go by ascending ``doc_id``, NULL last. Each row of either
    table stands for itself, so repeated rows are documents, or queries, of their own. NULL, empty and
    termless texts are never found and, as queries, find nothing; an empty table gives no rows. Other
    columns are not read. Queries are answered in blocks of bounded size, each over the whole index.
    """
    spark = index.sparkSession
    stated = index.where("n > 0").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    kind = dict(items.dtypes)[item]
    result = new_path(spark, "found")
    empty = f"{item} {kind}, rank int, doc_id bigint, score bigint"
    spark.createDataFrame([], empty).write.parquet(result)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for block in query_blocks(items, item, most_items, most_terms):
        if not stated["n"]:
            break
        block.width, block.n_docs, block.n_terms = width, stated["n"], stated["l"]
        frequencies = document_frequencies(docs, {t for found in block.found for t in found})
        block.weights = {t: weight(df, block.n_docs) for t, df in frequencies.items()}
        with scratch(spark):
            wave = FIRST_WAVE * k
            for _ in range(MOST_WAVES):
                leading = settle(_leading(index, block, wave), "leading")
                near = settle(_scored(docs, leading.select("query", "doc_id"), block, k), "near")
                places = best_rows(near, "query", order, k, "place").where(F.col("place") == k)
                scored = {r["query"]: r["score"] for r in places.collect()}  # one row a query at most
                least = [max(1, scored.get(q, 1)) for q in range(len(block))]
                lowest = leading.where(F.col("place") == wave).collect()  # as many rows at most
                if all(r["bound"] < least[r["query"]] for r in lowest):
                    break
                wave *= NEXT_WAVE
            pairs = settle(_reaching(index, block, least), "reaching")
            hits = settle(_scored(docs, pairs, block, k), "scored")
            ranked = best_rows(hits.drop("query"), "number", order, k, "rank")
            names = spark.createDataFrame(
                list(zip(block.numbers, block.ids)), f"number bigint, {item} {kind}"
            )  # one row for each query of the block
            found = ranked.join(F.broadcast(names), "number").select(item, "rank", "doc_id", "score")
            found.write.mode("append").parquet(result)
    return spark.read.schema(empty).parquet(result)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    docs = documents(spark, sf_dir)
    index = settle(build_index(docs), "sketches")
    return search(docs, index, documents(spark, sf_dir, "benchmark"))


RANKED_SEARCH_SQL = r"""
with terms as (
  select doc_id, t.term, count(*) tf
  from documents, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) t(term)
  group by all
),
lengths as (select doc_id, sum(tf)::bigint n from terms group by doc_id),
stated as (select count(*)::bigint n_docs, sum(n)::bigint n_terms from lengths),
factors as (select doc_id, 50 + (50 * n * n_docs) // n_terms m from lengths, stated),
asked as (
  select distinct item_id, t.term
  from benchmark, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) t(term)
),
weights as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint w
  from terms, stated where term in (select term from asked) group by term, n_docs
),
scores as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint score
  from asked join weights using (term) join terms using (term) join factors using (doc_id)
  group by all
),
ranked as (
  select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int "rank",
    doc_id, score
  from scores where score > 0
)
select * from ranked where "rank" <= 50
"""
