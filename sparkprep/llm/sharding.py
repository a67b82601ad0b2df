"""Sharding by a two-pass external shuffle.

Pass one scatters rows into buckets by a seeded hash, so that a bucket is a uniform sample that fits
in a task's memory. Pass two puts each bucket in a fixed order, shuffles it by Fisher and Yates and
writes it. The buckets one after the other are a random permutation of all rows; shards are equal
slices of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import documents, dropping
from sparkprep.workspace import new_path

ADDED = ("bucket", "position", "shard", "slot")
ROW_BYTES = 16
MOST_SENT = 1_000_000
"""Buckets whose first places are broadcast, 12 bytes each; with more, the join shuffles."""


def row_bytes(text: str = "text"):
    """UTF-8 bytes of the text, and a little for the row."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + ROW_BYTES


def _shuffle_bucket(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def shuffled() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            # numpy's permutation is the Fisher-Yates shuffle
            order = np.random.default_rng([seed, last]).permutation(rows.num_rows)
            rows = rows.take(pa.array(order))
            position = pa.array(np.arange(rows.num_rows, dtype=np.int64))
            rows = rows.append_column("position", position)
            yield from rows.combine_chunks().to_batches()

        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if held and buckets[start] != last:
                    yield from shuffled()
                    held = []
                last = int(buckets[start])
                held.append(batch.slice(start, end - start))
        if held:
            yield from shuffled()

    return run


def shuffle_into_buckets(
    docs: DataFrame, path: str, seed: int = 0, bucket_bytes: int = 16 << 20, text: str = "text"
) -> None:
    """Write ``docs`` to ``path`` as shuffled buckets, with ``bucket`` and ``position`` added.

    ``bucket_bytes`` is what a task can hold; set it to some hundred MB on large executors. The hash
    takes the whole row and the input split it lies in, so rows that are alike in every column are
    spread over buckets too, and a task that is run again scatters its rows as before.
    """
    docs = dropping(docs, *ADDED)
    total = docs.agg(F.sum(row_bytes(text))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    hashed = F.xxhash64(F.lit(seed), *(F.col(f"`{c}`") for c in docs.columns))
    scattered = docs.withColumn("_order", hashed).withColumn(
        "bucket",
        F.pmod(F.xxhash64(F.lit(seed), "_order", F.spark_partition_id()), F.lit(buckets)).cast("int"),
    )
    # A fixed order inside the bucket first: rows arrive in any order, and a task may be run again.
    bucketed = scattered.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "_order")
    bucketed = bucketed.drop("_order")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bucketed.schema)
    bucketed.mapInArrow(_shuffle_bucket(seed), f"{schema}, position bigint").write.parquet(path)


def read_shards(spark: SparkSession, path: str, n_shards: int) -> DataFrame:
    """The rows under ``path`` with ``shard`` and ``slot``; row counts of shards differ by one at most.

    A shard is a run of the buckets' rows: shard ``s`` of ``n`` holds places ``s * rows // n`` up to
    ``(s + 1) * rows // n``. The same files can be read as any number of shards.
    """
    rows = spark.read.parquet(path)
    # One row for each bucket, however many documents there are.
    counts = rows.groupBy("bucket").count().orderBy("bucket").collect()
    total = sum(c["count"] for c in counts)
    firsts, place = [], 0
    for c in counts:
        firsts.append((c["bucket"], place))
        place += c["count"]
    first = spark.createDataFrame(firsts, "bucket int, _first bigint")
    if len(firsts) <= MOST_SENT:
        first = F.broadcast(first)
    total = max(total, 1)
    placed = rows.join(first, "bucket").withColumn("_place", F.col("_first") + F.col("position"))
    # the last shard whose first place is at or before this one
    shard = F.expr(f"(_place * {n_shards} + {n_shards - 1}) div {total}")
    slot = F.col("_place") - F.expr(f"(shard * {total}L) div {n_shards}")
    placed = placed.withColumn("shard", shard).withColumn("slot", slot)
    return placed.withColumn("shard", F.col("shard").cast("int")).drop("_first", "_place")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 of row counts at most one apart (law ``rows``).

    A NULL text has size 16 and the checksum of no bytes, 0. An empty table gives no row; documents
    that are alike are placed independently of one another.
    """
    path = new_path(spark, "op1-shards")
    shuffle_into_buckets(documents(spark, sf_dir), path)
    return read_shards(spark, path, 40).select(
        "doc_id",
        row_bytes().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
