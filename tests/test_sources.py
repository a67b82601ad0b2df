import json
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from sparkprep import COMPLAINTS, get_spark, workspace
from sparkprep.session import s3a_options
from sparkprep.sources import landing, store, watermark
from sparkprep.streaming import load_new_files, stream_landing, stream_to_store
from sparkprep.workspace import new_path, settle

PAYLOAD = T.StructType(
    [
        T.StructField("complaint_id", T.StringType()),
        T.StructField("issue", T.StringType()),
        T.StructField("date_received", T.StringType()),
    ]
)


def record(key, issue="x", received="2023-05-02"):
    return {"_source": {"complaint_id": key, "issue": issue, "date_received": received}}


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([record("1"), {"detail": "none"}, record("2", None)]))
    (folder / "b.json").write_text("[]")
    (folder / "c.json").write_text("Request was throttled. Expected available in 42 seconds.")
    return folder


def test_landing_scan(spark, landed):
    df = landing.read_landing(spark, str(landed), PAYLOAD, whole_files=True)
    found = {r["complaint_id"]: r["issue"] for r in landing.unwrap(df).collect()}
    assert found == {"1": "x", "2": None}
    bad = landing.corrupt(df).collect()
    assert len(bad) == 1
    assert bad[0]["file"].endswith("c.json") and "42 seconds" in bad[0]["content"]
    counts = {r["outcome"]: r["n"] for r in landing.outcome_counts(df).collect()}
    assert counts == {"parsed": 2, "no payload": 1, "corrupt": 1}


def test_landing_lines(spark, tmp_path):
    lines = [json.dumps(record("1")), "oops", json.dumps({"other": 1})]
    (tmp_path / "a.json").write_text("\n".join(lines))
    df = landing.read_landing(spark, str(tmp_path / "a.json"), PAYLOAD, whole_files=False)
    counts = {r["outcome"]: r["n"] for r in landing.outcome_counts(df).collect()}
    assert counts == {"parsed": 1, "no payload": 1, "corrupt": 1}
    assert landing.corrupt(df).count() == 1


def test_typed_dates(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        json.dumps([record("1", received="2023-08-10T12:00:00-05:00"), record("2", received="abc")])
    )
    df = landing.read_landing(spark, str(tmp_path), COMPLAINTS.landing)
    rows = landing.typed(landing.unwrap(df), COMPLAINTS).selectExpr("cast(date_received as string) d").collect()
    assert [r["d"] for r in rows] == ["2023-08-10 17:00:00", None]


def batch(spark, *rows):
    return spark.createDataFrame(rows, "complaint_id string, issue string, date_received string")


def test_store_keeps_one_record_per_key(spark, tmp_path):
    path = str(tmp_path / "store")
    first = batch(spark, ("1", "a", "2023-05-01"), ("1", "b", "2023-05-01"), ("2", "c", "2023-06-01"))
    for _ in range(2):
        store.append_to_store(first, path, "complaint_id", "date_received")
    store.append_to_store(
        batch(spark, ("2", "z", "2023-07-01"), ("3", "d", "bad date")), path, "complaint_id", "date_received"
    )
    found = {r["complaint_id"]: (r["issue"], r["received_month"]) for r in store.read_table(spark, path).collect()}
    assert found["1"][0] == "b" and found["2"][0] == "c" and found["3"][0] == "d"
    assert len(found) == 3


def test_rows_without_a_key_are_kept_apart(spark):
    df = batch(spark, (None, "a", None), (None, "a", None), ("1", "a", None), ("1", "a", None))
    assert [r["complaint_id"] for r in store.one_per_key(df, "complaint_id").collect()] == ["1"]
    assert store.sorted_records(df, "complaint_id", "date_received")["unkeyed"].count() == 2
    assert store.one_per_key(df.select("complaint_id"), "complaint_id").count() == 1


def test_empty_batch_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    store.append_to_store(batch(spark, ("1", "a", "2023-05-01")), path, "complaint_id", "date_received")
    store.append_to_store(batch(spark).limit(0), path, "complaint_id", "date_received")
    assert store.read_table(spark, path).count() == 1


def test_store_is_pruned_by_month(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(str(m), "a", f"2023-0{m}-01") for m in range(1, 5)]
    store.append_to_store(batch(spark, *rows), path, "complaint_id", "date_received")
    plan = store.read_table(spark, path).where("received_month = '2023-02'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(received_month" in text
    assert plan.count() == 1


def test_store_is_not_shuffled_for_a_small_batch(spark, tmp_path):
    path = str(tmp_path / "store")
    store.append_to_store(batch(spark, ("1", "a", "2023-05-01")), path, "complaint_id", "date_received")
    small = settle(batch(spark, ("1", "b", "2023-05-01"), ("2", "c", "2023-05-01")), "batch")
    fresh = store.unseen(small, store.read_table(spark, path), "complaint_id")
    assert [r["complaint_id"] for r in fresh.collect()] == ["2"]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_schema_drift(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("1",)], "id string").write.parquet(path)
    spark.createDataFrame([("2", "x")], "id string, issue string").write.mode("append").parquet(path)
    assert set(store.read_table(spark, path).columns) == {"id", "issue"}


def test_absent_table(spark, tmp_path):
    assert store.read_if_present(spark, str(tmp_path / "none"), PAYLOAD) is None


def test_sinks(spark, tmp_path):
    df = spark.range(3)
    once = str(tmp_path / "once")
    assert store.write_once(df, once) == 3
    with pytest.raises(AnalysisException):
        store.write_once(df, once)
    for _ in range(2):
        store.append_rejects(df, str(tmp_path / "rejects"))
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 6


def test_watermark(spark, tmp_path):
    path = str(tmp_path / "w")
    assert watermark.latest(spark, path) is None
    watermark.advance(spark, path, date(2023, 5, 1), date(2023, 6, 1), "store")
    watermark.advance(spark, path, date(2023, 6, 1), date(2023, 7, 1), "store")
    assert watermark.latest(spark, path) == date(2023, 7, 1)
    assert watermark.watermarks(spark, path).count() == 2


def test_stream_loads_each_file_once(spark, landed, tmp_path):
    target, progress = str(tmp_path / "target"), str(tmp_path / "progress")

    def run():
        load_new_files(stream_landing(spark, str(landed), PAYLOAD, whole_files=True), target, progress)
        return sorted(r["complaint_id"] for r in spark.read.parquet(target).collect())

    assert run() == ["1", "2"]
    assert run() == ["1", "2"]
    (landed / "d.json").write_text(json.dumps([record("3")]))
    assert run() == ["1", "2", "3"]


def test_stream_to_store(spark, landed, tmp_path):
    root, target = str(tmp_path / "load"), str(tmp_path / "store")

    def run(progress):
        stream_to_store(
            stream_landing(spark, str(landed), PAYLOAD, whole_files=True, max_files=1),
            str(tmp_path / progress),
            root=root,
            store=target,
            key="complaint_id",
            received="date_received",
            min_start=date(2023, 1, 1),
        )
        return store.read_table(spark, target).count()

    assert run("p1") == 2
    assert spark.read.parquet(f"{root}/quarantine").count() == 1
    profile = spark.read.parquet(f"{root}/profiles")
    assert profile.where("column = 'issue'").groupBy().sum("missing_row").first()[0] == 1
    more = [record("2"), record("3"), record(None), record("4", received="soon"), record("5", received="2022-12-31")]
    (landed / "d.json").write_text(json.dumps(more))
    assert run("p1") == 3
    for name, keys in (("unkeyed", [None]), ("undated", ["4"]), ("early", ["5"])):
        assert [r["complaint_id"] for r in spark.read.parquet(f"{root}/{name}").collect()] == keys
    assert run("p1") == 3  # nothing new has landed
    # From an empty checkpoint every file is loaded again, which must not add a row.
    assert run("p2") == 3


def test_stream_looks_at_the_store_once(spark, tmp_path, monkeypatch):
    from sparkprep.streaming import landing as streaming

    for k in range(4):
        (tmp_path / "landing").mkdir(exist_ok=True)
        (tmp_path / "landing" / f"{k}.json").write_text(json.dumps(record(str(k))))
    calls = []
    monkeypatch.setattr(streaming, "append_to_store", lambda *a: calls.append(a) or store.append_to_store(*a))
    stream_to_store(
        stream_landing(spark, str(tmp_path / "landing"), PAYLOAD, max_files=1), str(tmp_path / "p"),
        root=str(tmp_path / "load"), store=str(tmp_path / "store"), key="complaint_id", received="date_received",
    )
    assert len(calls) == 1 and store.read_table(spark, str(tmp_path / "store")).count() == 4


def test_failed_load_is_taken_up_again(spark, tmp_path, monkeypatch):
    from sparkprep.streaming import landing as streaming

    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text(json.dumps(record("1")))

    def run():
        stream_to_store(
            stream_landing(spark, str(tmp_path / "landing"), PAYLOAD), str(tmp_path / "p"),
            root=str(tmp_path / "load"), store=str(tmp_path / "store"), key="complaint_id", received="date_received",
        )

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(streaming, "append_to_store", fail)
        with pytest.raises(RuntimeError):
            run()
    run()
    assert store.read_table(spark, str(tmp_path / "store")).count() == 1


def test_s3a_options():
    assert s3a_options() == {}
    assert s3a_options("k", "s", "e") == {
        "spark.hadoop.fs.s3a.access.key": "k",
        "spark.hadoop.fs.s3a.secret.key": "s",
        "spark.hadoop.fs.s3a.endpoint": "e",
    }
    with pytest.raises(ValueError):
        s3a_options(access_key="k")


def test_session_settings(spark):
    assert get_spark() is not None
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_shared_folder_is_the_session_s(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x").startswith(folder)
    assert settle(spark.range(5), "x").count() == 5


def test_discarding_removes_only_own_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_folder", lambda _: str(tmp_path))
    (tmp_path / "other").mkdir()
    assert settle(spark.range(5), "x").count() == 5
    workspace.discard_settled(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]
