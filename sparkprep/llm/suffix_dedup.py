"""Exact substring dedup by a hash-compared suffix sort.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too. Comparing the
suffixes at all places is too much, so each place is first given an anchor: of the ``GRAM``-byte grams
inside the ``length`` bytes from there, the one of the least hash. Equal strings have equal anchors at
equal distances. The places that have one anchor are a run, and the bytes from the run's first place to
the end of its last string are its context.

1. Anchors are compared by hash. If two have equal contexts, all their strings are repeated. If only
   the grams are equal, the contexts go on to be sorted.
2. Suffixes of contexts that begin at one distance before equal anchors are sorted by merging. Prefix
   polynomial hashes give the hash of any substring, and a binary search over them the common extension
   of two suffixes, so a comparison takes a logarithmic number of steps. Neighbours that agree on
   ``length`` bytes are compared byte by byte, which a collision of hashes does not pass.

An anchor so common that its contexts fit no task has its strings compared by hash alone, counted map-side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import documents, dropping, hot_join, pieces
from sparkprep.llm.hashing import PrefixHashes, by_fragment, mixed
from sparkprep.workspace import settle

GRAM_SHARE = 4
"""A gram is this part of the length; shorter grams have fewer anchors, but more chance matches."""

ADDED = ("n_bytes", "n_removed", "n_spans", "kept")

ANCHOR = np.dtype(
    [("gram", "<u8"), ("context", "<u8"), ("node", "<i8"), ("at", "<i4"), ("before", "<i4"), ("after", "<i4"), ("many", "u1")]
)
"""An anchor: hashes of its gram and context, its text and place there, its places before and after."""


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each ``width`` neighbours, from running minima inside blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], nodes: list[int], length: int) -> np.ndarray:
    """Anchors of all places of the texts at which a string of ``length`` bytes starts."""
    held = [(t, n) for t, n in zip(texts, nodes) if len(t) >= length]
    if not held:
        return np.zeros(0, ANCHOR)
    gram = length // GRAM_SHARE
    data = np.frombuffer(b"".join(t for t, _ in held), np.uint8)
    sizes = np.array([len(t) for t, _ in held], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    hashes = PrefixHashes(data)
    places = np.arange(len(data) - gram + 1)
    grams = mixed(hashes.of(places, places + gram))
    # the hash above, the place below: the least is the leftmost gram of the least hash
    bits = np.uint64(max(1, int(len(places)).bit_length()))
    ranked = (grams >> bits << bits) | places.astype(np.uint64)
    least = window_minima(ranked, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))
    text = np.repeat(np.arange(len(held)), np.maximum(sizes - length + 1, 0))
    start = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(first[:-1], first[1:])])
    chosen = least[start].astype(np.int64)
    # the places with one anchor are neighbours, and an anchor is inside one text
    begins = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1]))))
    ends = np.append(begins[1:], len(chosen)) - 1
    found = np.zeros(len(begins), ANCHOR)
    at = chosen[begins]
    found["gram"] = grams[at]
    found["before"] = at - start[begins]
    found["after"] = start[ends] - at
    whole = hashes.of(start[begins], start[ends] + length)
    shape = found["before"].astype(np.uint64) * np.uint64(2 * length) + (
        found["after"] + length
    ).astype(np.uint64)
    found["context"] = mixed(whole + mixed(shape))
    found["node"] = np.array([n for _, n in held], np.int64)[text[begins]]
    found["at"] = at - first[text[begins]]
    return found


def _distinct(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors sorted by gram and context, each once; which begin a context; the contexts' sizes."""
    found = found[np.lexsort((found["at"], found["node"], found["context"], found["gram"]))]
    same = lambda *names: np.logical_and.reduce(
        [found[c][1:] == found[c][:-1] for c in names]
    )
    if len(found):
        repeated = np.concatenate(([False], same("gram", "context", "node", "at")))
        if repeated.any():
            # a text read twice is one text; what is known of its anchor in one chunk holds in all
            group = np.cumsum(~repeated) - 1
            many = np.zeros(group[-1] + 1, np.uint8)
            np.maximum.at(many, group, found["many"])
            found = found[~repeated]
            found["many"] = many
    first = np.flatnonzero(np.concatenate(([True], ~same("gram", "context")))) if len(found) else np.zeros(0, int)
    return found, first, np.diff(np.append(first, len(found)))


def _spans(found: np.ndarray, length: int) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "node": found["node"],
            "start": found["at"] - found["before"],
            "end": found["at"] + found["after"] + length,
        }
    )


def _scatter(length: int, fragments: int, chunk_bytes: int):
    """Anchors for each fragment of gram hashes, and spans that a chunk settles by itself.

    Of equal contexts inside a chunk one goes on, marked as ``many``: the others are known to repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", chunk_bytes):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            found = anchors(texts, batch.column("node").to_pylist(), length)
            found, first, counts = _distinct(found)
            if not len(found):
                continue
            shared = np.repeat(counts > 1, counts)
            told = found[shared]
            sent = found[first]
            sent["many"] = counts > 1
            rows = [(f, 0, part.tobytes()) for f, part in by_fragment(sent, sent["gram"], fragments)]
            if len(told):
                rows.append((int(told["node"][0] % fragments), 1, told.tobytes()))
            kinds, columns = (pa.int32(), pa.int32(), pa.binary()), zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["fragment", "kind", "anchors"]
            )

    return run


def _compare(length: int, hot_contexts: int):
    """Spans whose contexts repeat (``kind`` 1), and anchors to sort (2; 3 if very common)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        read = lambda kind: np.frombuffer(
            b"".join(rows.loc[rows["kind"] == kind, "anchors"]), ANCHOR
        )
        told = _spans(read(1), length)
        found, first, counts = _distinct(read(0))
        if not len(found):
            return told.assign(kind=1, gram=0, at=0)
        many = np.maximum.reduceat(found["many"], first) > 0
        repeats = np.repeat((counts > 1) | many, counts)
        full = _spans(found[repeats & (found["many"] == 0)], length)
        # one of each context goes on where a gram has several contexts
        heads = found[first]
        alike = heads["gram"][1:] == heads["gram"][:-1]
        grams = np.flatnonzero(np.concatenate(([True], ~alike)))
        contexts = np.repeat(np.diff(np.append(grams, len(heads))), np.diff(np.append(grams, len(heads))))
        edge = ~((counts > 1) | many)
        open_ = np.repeat(np.maximum.reduceat(edge, grams), np.diff(np.append(grams, len(heads))))
        going = open_ & (contexts > 1)
        more = _spans(heads[going], length).assign(
            kind=np.where(contexts[going] > hot_contexts, 3, 2),
            gram=heads["gram"][going].view(np.int64),
            at=heads["at"][going],
        )
        done = pd.concat([told, full]).assign(kind=1, gram=0, at=0)
        return pd.concat([done, more])

    return run


def common_extension(
    hashes: PrefixHashes, a: np.ndarray, b: np.ndarray, most: int
) -> np.ndarray:
    """How many bytes, ``most`` at most, the suffixes at ``a`` and ``b`` have in common."""
    low = np.zeros(len(a), np.int64)
    high = np.full(len(a), most, np.int64)
    for _ in range(int(most).bit_length()):
        middle = (low + high + 1) // 2
        same = hashes.of(a, a + middle) == hashes.of(b, b + middle)
        low = np.where(same, middle, low)
        high = np.where(same, high, middle - 1)
    return low


def _before(hashes: PrefixHashes, data: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Whether the suffix at ``a`` sorts before that at ``b``; equal ones don't."""
    common = common_extension(hashes, a, b, most)
    differ = common < most
    step = np.where(differ, common, 0)
    return differ & (data[a + step] < data[b + step])


def suffix_order(
    data: np.ndarray, hashes: PrefixHashes, group: np.ndarray, start: np.ndarray, most: int
) -> np.ndarray:
    """Order of suffixes by group, then by their first ``most`` bytes: a bottom-up merge sort.

    All merges of a level are done at once. The place of a suffix in a merged run is its place in its
    own run and, by binary search, the number of suffixes of the other run that go before it.
    """
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], group[order][1:] != group[order][:-1])))
    sizes = np.diff(np.append(first, len(order)))
    base = np.repeat(first, sizes)
    inside = np.arange(len(order)) - base
    size = np.repeat(sizes, sizes)
    width = 1
    while width < sizes.max(initial=1):
        # only groups that are longer than the runs have anything to merge
        moving = np.flatnonzero(size > width)
        place, bottom = inside[moving], base[moving]
        run = place // width
        right = run % 2 == 1
        other = np.where(right, run - 1, run + 1) * width
        end = np.minimum(other + width, size[moving])
        low = np.minimum(other, end)
        begin = low.copy()
        high = end.copy()
        own = start[order[moving]]
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            middle = (low[live] + high[live]) // 2
            facing = start[order[bottom[live] + middle]]
            less = _before(hashes, data, facing, own[live], most)
            # a suffix of the left run goes before an equal one of the right run
            tie = right[live] & ~less & ~_before(hashes, data, own[live], facing, most)
            goes = less | tie
            low[live] = np.where(goes, middle + 1, low[live])
            high[live] = np.where(goes, high[live], middle)
        target = (run // 2) * 2 * width + (place - run * width) + (low - begin)
        merged = order.copy()
        merged[bottom + target] = order[moving]
        order = merged
        width *= 2
    return order


def repeated_places(
    contexts: list[bytes], grams: np.ndarray, before: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """(context, place) of strings of ``length`` bytes that another context has at the same distance."""
    data = np.frombuffer(b"".join(contexts) + bytes(length), np.uint8)
    sizes = np.array([len(c) for c in contexts], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(contexts)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = first[owner] + inside
    distance = (before[owner] - inside + 4 * length).astype(np.uint64)
    group = mixed(grams.view(np.uint64)[owner] + mixed(distance))
    hashes = PrefixHashes(data)
    order = suffix_order(data, hashes, group, start, length)
    left, right = order[:-1], order[1:]
    pair = np.flatnonzero(group[left] == group[right])
    pair = pair[common_extension(hashes, start[left[pair]], start[right[pair]], length) >= length]
    # collisions: what the hashes call equal is compared byte by byte
    kept = []
    for part in np.array_split(pair, max(1, len(pair) // 4096)):
        offsets = np.arange(length)
        one, two = start[left[part]][:, None] + offsets, start[right[part]][:, None] + offsets
        kept.append(part[(data[one] == data[two]).all(axis=1)])
    pair = np.concatenate(kept) if kept else pair
    repeated = np.zeros(len(start), bool)
    repeated[left[pair]] = True
    repeated[right[pair]] = True
    return owner[repeated], inside[repeated]


def _joined_spans(nodes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    """Ranges of each node with overlapping ones joined."""
    order = np.lexsort((starts, nodes))
    nodes, starts, ends = nodes[order], starts[order], ends[order]
    if not len(nodes):
        return pd.DataFrame({"node": nodes, "start": starts, "end": ends})
    fresh = np.concatenate(([True], nodes[1:] != nodes[:-1]))
    # ranges of one length begin and end in the same order
    gap = fresh | np.concatenate(([True], starts[1:] > ends[:-1]))
    first = np.flatnonzero(gap)
    return pd.DataFrame(
        {"node": nodes[first], "start": starts[first], "end": np.maximum.reduceat(ends, first)}
    )


def _sort_contexts(length: int, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def settled(rows: list[dict]) -> pa.RecordBatch:
            grams = np.array([r["gram"] for r in rows], np.int64)
            before = np.array([r["at"] - r["start"] for r in rows], np.int64)
            owner, inside = repeated_places([r["bytes"] for r in rows], grams, before, length)
            nodes = np.array([r["node"] for r in rows], np.int64)
            starts = np.array([r["start"] for r in rows], np.int64)[owner] + inside
            spans = _joined_spans(nodes[owner], starts, starts + length)
            return pa.RecordBatch.from_pandas(spans, pa.schema(_SPAN_FIELDS), preserve_index=False)

        size, last = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if size > batch_bytes and row["gram"] != last:
                    yield settled(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
                last = row["gram"]
        if held:
            yield settled(held)

    return run


_SPAN_FIELDS = [("node", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]
_SPANS = "node bigint, start bigint, end bigint"


def _string_hashes(length: int):
    """Each string of a very common anchor's context, by hash, with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "bytes", 1 << 18):
            out = []
            for row in batch.to_pylist():
                data = np.frombuffer(row["bytes"], np.uint8)
                places = np.arange(len(data) - length + 1)
                found = mixed(PrefixHashes(data).of(places, places + length)).view(np.int64)
                n = len(places)
                out.append((found, np.full(n, row["node"]), places + row["start"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], ["hash", "node", "start"]
            )

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts cut from their texts."""
    names = ("gram", "node", "at", "start", "kind")
    for batch in pieces(batches, "text", 1 << 20):
        for row in batch.to_pylist():
            data = row["text"].encode()
            wanted = row["wanted"]
            columns = [[w[c] if c != "node" else row["node"] for w in wanted] for c in names]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns), pa.array([data[w["start"] : w["end"]] for w in wanted])],
                [*names, "bytes"],
            )


def _apply(length: int, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", 4 << 20):
            texts, spans = batch.column("_text").to_pylist(), batch.column("_spans").to_pylist()
            sizes, removed, runs, kept = [], [], [], []
            for text, found in zip(texts, spans):
                data = (text or "").encode()
                found = sorted((s["start"], s["end"]) for s in found or ())
                parts, place, n, gone = [], 0, 0, 0
                for start, end in found:
                    start, end = max(start, 0), min(end, len(data))
                    if end <= place and n:
                        continue
                    if start > place or not n:
                        parts.append(data[place:start])
                        n += 1
                        gone += end - start
                    else:
                        gone += end - place
                    place = end
                parts.append(data[place:])
                sizes.append(len(data))
                removed.append(gone)
                runs.append(n)
                kept.append(b"".join(parts))
            columns = {c: batch.column(c) for c in keep}
            for name, values in zip(ADDED, (sizes, removed, runs)):
                columns[name] = pa.array(values, pa.int64())
            yield pa.RecordBatch.from_pydict({**columns, "kept": pa.array(kept, pa.binary())})

    return run


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    length: int = 200,
    fragment_bytes: int = 8 << 20,
    chunk_bytes: int = 1 << 19,
    hot_contexts: int = 20_000,
) -> DataFrame:
    """``docs`` without the text, with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (bytes).

    Texts are UTF-8 bytes and NULL is empty; what is left may begin or end inside a character. Strings
    are judged on the texts as given. Of rows with equal texts of ``length`` bytes or more, nothing is
    kept. ``fragment_bytes`` is what a task holds of the anchors, ``chunk_bytes`` of text are combined
    before the shuffle, and a gram of more than ``hot_contexts`` contexts is compared by hash.
    """
    docs = dropping(docs, *ADDED)
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("node"),
    ).where(F.octet_length("text") >= length)
    classes = rows.groupBy("node", F.octet_length("text").alias("size"), F.crc32("text").alias("crc")).agg(
        F.count("*").alias("rows"), F.min("doc_id").alias("least")
    )
    classes = settle(classes, "suffix-classes")
    total = int(classes.agg(F.sum("size")).first()[0] or 0)
    gram = length // GRAM_SHARE
    expected = 2 * total // (length - gram + 2) * ANCHOR.itemsize
    fragments = max(1, -(-expected // fragment_bytes))

    sent = rows.select("text", "node").mapInArrow(
        _scatter(length, fragments, chunk_bytes), "fragment int, kind int, anchors binary"
    )
    compared = sent.groupBy("fragment").applyInPandas(
        _compare(length, hot_contexts), f"{_SPANS}, kind int, gram bigint, at bigint"
    )
    compared = settle(compared, "suffix-compared")

    wanted = compared.where("kind > 1").groupBy("node").agg(
        F.collect_set(F.struct("gram", "at", "start", "end", "kind")).alias("wanted")
    )
    # one row of each text: the least id, and any of those with that id
    chosen = classes.select("node", F.col("least").alias("_least"))
    wanted = wanted.join(chosen, "node")
    texts = rows.join(
        wanted.withColumnRenamed("node", "_node"),
        (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_least")),
    )
    cut = texts.select("text", "node", "wanted").mapInArrow(
        _cut, "gram bigint, node bigint, at bigint, start bigint, kind bigint, bytes binary"
    )
    cut = settle(cut, "suffix-contexts")
    ordered = cut.where("kind = 2").repartition("gram").sortWithinPartitions("gram", "node", "start")
    sorted_spans = ordered.mapInArrow(_sort_contexts(length, 1 << 19), _SPANS)

    strings = cut.where("kind = 3").mapInArrow(_string_hashes(length), "hash bigint, node bigint, start bigint")
    strings = settle(strings.distinct(), "suffix-strings")
    common = strings.groupBy("hash").agg(F.count("*").alias("rows")).where("rows > 1")
    hot_spans = hot_join(strings, settle(common, "suffix-common"), ["hash"], "rows").select(
        "node", "start", (F.col("start") + length).alias("end")
    )

    copied = classes.where("rows > 1").select(
        "node", F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end")
    )
    spans = (
        compared.where("kind = 1").select("node", "start", "end")
        .unionByName(sorted_spans).unionByName(hot_spans).unionByName(copied)
    )
    spans = spans.groupBy("node").agg(F.collect_set(F.struct("start", "end")).alias("_spans"))
    spans = spans.join(classes.groupBy("node").agg(F.sum("rows").alias("rows")), "node")
    spans = settle(spans.withColumnRenamed("node", "_node"), "suffix-spans")

    kept = [c for c in docs.columns if c != text]
    whole = docs.select(
        *(F.col(f"`{c}`") for c in kept),
        F.col(text).alias("_text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_node"),
    )
    joined = hot_join(whole, spans, ["_node"], "rows", how="left").drop("_node")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)
    added = "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    return joined.mapInArrow(_apply(length, kept), f"{schema}, {added}")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that 200-byte repeats cover, removed."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
