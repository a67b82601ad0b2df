import pytest
from pyspark.sql import functions as F

from sparkprep.sources import store
from sparkprep.sources.key_index import KeyIndex
from sparkprep.workspace import list_files, settle


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def load(spark, path, ids):
    df = spark.createDataFrame([(i, "2023-05-01") for i in ids], "id bigint, received string")
    store.append_to_store(df, path, "id", "received")
    return KeyIndex(spark, store.index_path(path), df.schema["id"])


def stored(spark, path):
    return sorted(r["id"] for r in store.read_table(spark, path).collect())


@pytest.fixture
def unbroadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_are_not_shuffled(spark, tmp_path, unbroadcast):
    """Only the batch is dealt out; the bucketed keys are read where they lie."""
    index = load(spark, str(tmp_path / "store"), range(3000))
    batch = settle(spark.range(2000, 5000), "batch")
    fresh = index.unseen(batch, few_keys=100)
    text = plan(fresh)
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
    assert sorted(r["id"] for r in fresh.collect()) == list(range(3000, 5000))


def test_few_keys_read_their_buckets_only(spark, tmp_path):
    index = load(spark, str(tmp_path / "store"), range(3000))
    batch = settle(spark.createDataFrame([(5,), (9999,), (None,)], "id bigint"), "batch")
    # the plan names the buckets only where it keeps them apart, which this scan has no need for
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        text = plan(index.known(batch))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    selected = text[text.index("SelectedBucketsCount: ") :].split()[1:5]
    assert int(selected[0]) <= 2 and int(selected[3].rstrip(",")) == 8
    assert "In(id" in text or "id IN" in text or "EqualTo(id" in text
    assert {r["id"] for r in index.unseen(batch).collect()} == {9999, None}
    assert index.unseen(batch.limit(0)).count() == 0


def test_index_follows_the_store(spark, tmp_path):
    path = str(tmp_path / "store")
    load(spark, path, range(50))
    index = load(spark, path, [*range(40, 60), 58])
    assert sorted(r["id"] for r in index.keys().collect()) == list(range(60)) == stored(spark, path)
    assert load(spark, path, range(60)).keys().count() == 60
    assert index.is_sound()


def test_failed_loads_are_mended(spark, tmp_path, monkeypatch):
    """A load that ends after it has written the store, and one that ends before it has."""
    path = str(tmp_path / "store")
    load(spark, path, range(10))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(KeyIndex, "add", fail)
        with pytest.raises(RuntimeError):
            load(spark, path, range(5, 20))
    index = load(spark, path, range(15, 25))
    assert stored(spark, path) == list(range(25))
    with monkeypatch.context() as patched:
        patched.setattr(store, "as_timestamp", fail)
        with pytest.raises(RuntimeError):
            load(spark, path, range(30))
    load(spark, path, range(28))
    assert stored(spark, path) == list(range(28)) == sorted(r["id"] for r in index.keys().collect())


def test_store_without_an_index(spark, tmp_path):
    path = str(tmp_path / "store")
    old = spark.range(5).withColumn("received", F.lit("2023-05-01")).withColumn(store.MONTH, F.lit("2023-05"))
    old.write.partitionBy(store.MONTH).parquet(path)
    load(spark, path, range(3, 8))
    assert stored(spark, path) == list(range(8))


def test_many_files_are_written_anew(spark, tmp_path, monkeypatch):
    from sparkprep.sources import key_index

    monkeypatch.setattr(key_index, "MOST_FILES", 2)
    path = str(tmp_path / "store")
    for k in range(4):
        index = load(spark, path, range(100 * k, 100 * k + 100))
    version = index._version()
    assert version["version"] >= 1 and len(list_files(spark, version["folder"])) <= 16
    assert sorted(r["id"] for r in index.keys().collect()) == list(range(400)) == stored(spark, path)
    KeyIndex(spark, index.path, index.field, bucket_keys=10).write_anew(index.keys())
    assert index._version()["buckets"] == 64 and index.keys().count() == 400
    assert load(spark, path, range(390, 410)).keys().count() == 410


def test_text_keys(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([("a'b", "2023-05-01"), ("", "2023-05-01"), (None, "x")], "`the key` string, received string")
    for _ in range(2):
        store.append_to_store(df, path, "the key", "received")
    assert sorted(r["the key"] for r in store.read_table(spark, path).collect()) == ["", "a'b"]
