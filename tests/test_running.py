import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkprep.operators import categories as c
from sparkprep.operators import running, windows
from sparkprep.workspace import settle
from datetime import date, datetime


def record_all(spark, path, loads, fit):
    for load, df in loads:
        running.record(fit(df), path, load)
    return running.recorded(spark, path)


def test_merged_counts_equal_one_fit(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None, "c"]), rng.choice([1, 2, None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "s string, k int").withColumn("i", F.monotonically_increasing_id() % 3)
    loads = [(f"load {i}", df.where(F.col("i") == i).drop("i")) for i in (0, 1, 2, 1)]
    fit = lambda d: c.category_counts(d, ["s", "k"])
    merged = running.merge_counts(record_all(spark, str(tmp_path / "s"), loads, fit))
    whole = fit(df)
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    assert c.modes(settle(merged, "m")) == c.modes(whole)


def test_merged_moments(spark, tmp_path):
    rng = random.Random(2)
    values = [1e12 + rng.random() for _ in range(500)]
    parts = [values[:1], values[1:1], values[1:200], values[200:]]
    loads = [
        (str(i), spark.createDataFrame([(v, None) for v in part] + [(None, None), (float("nan"), None)], "x double, none double"))
        for i, part in enumerate(parts)
    ]
    states = record_all(spark, str(tmp_path / "s"), loads, lambda d: running.moments(d, ["x", "none"]))
    found = {r["column"]: r for r in running.merge_moments(states).collect()}
    assert found["x"]["n"] == 500
    assert found["x"]["mean"] == pytest.approx(statistics.fmean(values), rel=1e-12)
    assert found["x"]["deviation"] == pytest.approx(statistics.stdev(values), rel=1e-3)
    assert found["none"]["n"] == 0 and found["none"]["mean"] is None and found["none"]["deviation"] is None
    one = running.merge_moments(running.moments(loads[0][1], ["x"])).first()
    assert one["n"] == 1 and one["deviation"] is None


def test_merged_distinct(spark, tmp_path):
    loads = [
        ("a", spark.range(0, 60_000).select((F.col("id") % 40_000).alias("k"), F.lit(None).cast("int").alias("none"))),
        ("b", spark.range(30_000, 90_000).select(F.col("id").alias("k"), F.lit(1).alias("none"))),
    ]
    states = record_all(spark, str(tmp_path / "s"), loads, running.distinct_state)
    assert states.count() == 4
    found = {r["column"]: r for r in running.merge_distinct(states).collect()}
    assert found["k"]["n_unique"] == pytest.approx(90_000, rel=0.05) and found["k"]["missing_row"] == 0
    assert found["none"]["n_unique"] == 2 and found["none"]["missing_percentage"] == 50.0


def test_windows_are_replaced(spark, tmp_path):
    path = str(tmp_path / "w")
    rows = [(k, datetime(2023, 1 + k % 4, 5)) for k in range(40)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, ts timestamp")
    first, unit = date(2023, 1, 5), "month"

    def found():
        held = spark.read.parquet(path).collect()
        assert all(r["window_from"] == max(date(2023, r["ts"].month, 1), first) for r in held)
        return Counter(r["id"] for r in held)

    for _ in range(2):
        windows.write_windows(df, "ts", path, first, unit)
        assert found() == Counter(range(40))
    march = (date(2023, 3, 1), date(2023, 4, 1))
    windows.rewrite_window(df.where("id <> 2"), "ts", path, march, first, unit)
    assert found() == Counter(k for k in range(40) if k != 2)
    windows.rewrite_window(df.where("id % 4 <> 2"), "ts", path, march, first, unit)
    assert found() == Counter(k for k in range(40) if k % 4 != 2)
    windows.rewrite_window(df, "ts", path, march, first, unit)
    assert found() == Counter(range(40))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_several_large_columns(spark, monkeypatch, how):
    """One write for all of them, and the same rows as one column after the other."""
    value = lambda m, k: F.when(F.col("id") % m == 0, None).when(F.col("id") % m < k, "hot").otherwise(
        F.concat(F.lit("v"), F.col("id") * 7919 % 211)
    )
    df = spark.range(4000).select("id", value(5, 3).alias("a"), value(3, 2).alias("b"), value(7, 1).alias("c"))
    counts = settle(c.category_counts(df.where("id < 3000"), ["a", "b", "c"]), "t")
    outputs = {"a": "fa", "b": "fb", "c": "fc"}
    whole = c.encode_frequency(df, counts, outputs, how=how).collect()
    written = []
    monkeypatch.setattr(c, "settle", lambda d, name: written.append(name) or settle(d, name))
    found = c.encode_frequency(df, counts, outputs, how=how, max_rows=20)
    assert written == ["marked"]
    assert sorted(found.collect()) == sorted(whole) and found.columns == ["id", "a", "b", "c", "fa", "fb", "fc"]
