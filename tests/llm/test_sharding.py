import zlib
from collections import Counter

import pytest

from sparkprep.llm.sharding import read_shards, shuffle_into_buckets
from sparkprep.workspace import new_path
from cases import ODD


def shards(spark, docs, n=7, **options):
    path = new_path(spark, "test-shards")
    shuffle_into_buckets(docs, path, **options)
    return read_shards(spark, path, n)


@pytest.mark.parametrize("bucket_bytes", [500, 1 << 20])
def test_counts_and_slots(spark, table, prose, bucket_bytes):
    rows = [(i, prose(i % 50, i)) for i in range(300)] + [(0, "same")] * 200
    found = shards(spark, table(rows).repartition(5), bucket_bytes=bucket_bytes).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    by_shard = {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert sorted(by_shard) == list(range(7))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    sizes = [len(s) for s in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1


def test_seed_decides(spark, table, prose):
    docs = table([(i, prose(20, i)) for i in range(100)]).coalesce(1)
    order = lambda seed: [r.doc_id for r in shards(spark, docs, seed=seed).orderBy("shard", "slot").collect()]
    assert order(1) == order(1)
    assert order(1) != order(2)
    assert order(1) != list(range(100))


def test_odd_rows(spark, table):
    found = shards(spark, table(ODD, extra=True), n=3).collect()
    assert len(found) == len(ODD)
    assert {r.shard for r in found} == {0, 1, 2}
    assert shards(spark, table([]), n=3).count() == 0


def test_query(spark):
    from sparkprep.llm.sharding import op1_sharding

    rows = op1_sharding(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts) == 200
    assert Counter(r.shard for r in rows) == {s: 5 for s in range(40)}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "rows")
