import json
from datetime import date

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from sparkprep import workspace
from sparkprep.plans import training
from sparkprep.sources import store, watermark
from sparkprep.sources.tables import complaints

SF_DIR = "/root/testdata/sf0.001"


def land(spark, path, low, high):
    """Complaints of a key range as landed lines, dated into 2023."""
    df = complaints(spark, SF_DIR).where(F.col("complaint_id").between(low, high - 1))
    dates = {
        "date_received": F.expr("date_add(date'2023-05-01', cast(complaint_id % 60 as int))"),
        "date_sent_to_company": F.expr("date_add(date'2023-05-03', cast(complaint_id % 70 as int))"),
    }
    df = df.withColumns(dates).select(*(F.col(c).cast("string").alias(c) for c in df.columns))
    df.select(F.struct("*").alias("_source")).write.mode("append").json(path)


def config(tmp_path, run_id, **changes):
    return training.RunConfig(
        root=str(tmp_path / "root"),
        run_id=run_id,
        landing=str(tmp_path / "landing"),
        whole_files=False,
        **changes,
    )


def test_full_run_then_increment(spark, tmp_path):
    first = config(tmp_path, "r1", to_date=date(2023, 6, 1))
    land(spark, first.landing, 0, 1000)
    out = training.run(spark, first)
    expected = sum(1 for i in range(1000) if i % 60 < 31)
    assert out.n_train + out.n_test == expected
    assert 0.6 < out.n_train / expected < 0.8
    assert spark.read.parquet(out.train).count() == out.n_train
    assert spark.read.parquet(out.train).columns == ["scaled_input_features", "consumer_disputed"]
    assert PipelineModel.load(out.model).stages
    assert watermark.latest(spark, first.watermark) == date(2023, 6, 1)
    rejected = spark.read.parquet(first.output("rejected"))
    assert "company_public_response" in rejected.columns and "error_msg" in rejected.columns

    second = config(tmp_path, "r2", to_date=date(2023, 7, 15), balanced=True, row_cap=800)
    out = training.run(spark, second)
    assert store.read_table(spark, second.store).count() == 1000
    labels = [spark.read.parquet(p) for p in (out.train, out.test)]
    sizes = labels[0].unionAll(labels[1]).groupBy("consumer_disputed").count().collect()
    assert len({r["count"] for r in sizes}) == 1 and len(sizes) == 2


def test_repeat_of_a_range_adds_nothing(spark, tmp_path):
    run = config(tmp_path, "r1", to_date=date(2023, 7, 15))
    land(spark, run.landing, 0, 200)
    training.ingest(spark, run)
    stored = store.read_table(spark, run.store).count()
    # Watermark and upper bound are equal now: nothing to do.
    assert training.ingest(spark, run).from_date == date(2023, 7, 15)
    # Stored records offered again meet their own keys.
    store.append_to_store(
        store.read_table(spark, run.store).drop(store.MONTH), run.store, "complaint_id", "date_received"
    )
    assert store.read_table(spark, run.store).count() == stored == 200


def test_late_unkeyed_and_early_records_are_not_lost(spark, tmp_path):
    """A record that lands after its date's range was loaded is stored; others have their own tables."""
    line = '{{"_source": {{"complaint_id": {}, "date_received": "{}"}}}}\n'
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.json").write_text(line.format('"1"', "2023-06-20") + line.format("null", "2023-06-20"))
    first = config(tmp_path, "r1", to_date=date(2023, 7, 1))
    done = training.ingest(spark, first)
    assert spark.read.parquet(done.unkeyed).count() == 1
    (folder / "b.json").write_text(
        line.format('"2"', "2023-06-15") + line.format('"3"', "2023-04-15") + line.format('"4"', "2023-09-01")
    )
    second = config(tmp_path, "r2", to_date=date(2023, 8, 1))
    done = training.ingest(spark, second)
    keys = lambda df: sorted(r["complaint_id"] for r in df.collect())
    assert keys(store.read_table(spark, second.store)) == ["1", "2", "4"]
    assert keys(training.read_store(spark, second, date(2023, 8, 1))) == ["1", "2"]
    assert keys(spark.read.parquet(done.early)) == ["3"]
    assert spark.read.parquet(done.unkeyed).count() == 0


def test_only_new_files_are_parsed(spark, tmp_path, monkeypatch):
    seen = []
    unwrap = training.landing.unwrap
    monkeypatch.setattr(
        training.landing, "unwrap", lambda df: seen.append({r["_file"] for r in df.collect()}) or unwrap(df)
    )
    for run_id, day, low in (("r1", date(2023, 6, 1), 0), ("r2", date(2023, 7, 1), 100)):
        run = config(tmp_path, run_id, to_date=day)
        land(spark, run.landing, low, low + 100)
        training.ingest(spark, run)
    assert len(seen) == 2 and seen[0] and seen[1] and not seen[0] & seen[1]
    assert store.read_table(spark, run.store).count() > 0


def test_a_run_leaves_nothing_settled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_folder", lambda _: str(tmp_path / "shared"))
    run = config(tmp_path, "r1", to_date=date(2023, 7, 15))
    land(spark, run.landing, 0, 300)
    training.run(spark, run)
    left = [p for p in (tmp_path / "shared").glob("*/*")]
    assert left == []
    failing = config(tmp_path, "r2", to_date=date(2023, 7, 20), missing_threshold=-1.0)
    land(spark, failing.landing, 300, 320)
    with pytest.raises(Exception):
        training.run(spark, failing)
    assert [p for p in (tmp_path / "shared").glob("*/*")] == []


def test_corrupt_landing_goes_to_quarantine(spark, tmp_path):
    run = config(tmp_path, "r1", to_date=date(2023, 7, 15))
    land(spark, run.landing, 0, 50)
    (tmp_path / "landing" / "throttled.json").write_text("Expected available in 42 seconds.\n")
    undated = '{"_source": {"complaint_id": "x", "date_received": "soon"}}\n'
    (tmp_path / "landing" / "undated.json").write_text(undated)
    done = training.ingest(spark, run)
    assert spark.read.parquet(done.quarantine).count() == 1
    assert [r["complaint_id"] for r in spark.read.parquet(done.undated).collect()] == ["x"]
    assert store.read_table(spark, run.store).count() == 50
