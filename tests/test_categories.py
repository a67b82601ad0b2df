from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkprep.operators import categories as c
from sparkprep.workspace import settle


@pytest.fixture
def ties(spark):
    values = ["b", "b", "a", "a", None, None, None]
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s string")


def test_counts_keep_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "s string")
    found = {r["category"]: r["n"] for r in c.category_counts(df, ["s"]).collect()}
    assert found == {"a": 2, None: 1}


def test_tie_goes_to_the_lowest_value(ties):
    assert c.modes(c.category_counts(ties, ["s"])) == {"s": "a"}


def test_all_null_column_has_no_mode(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert c.modes(c.category_counts(df, ["s"])) == {}


def test_fold_missing_equals_recount(ties):
    counts = c.category_counts(ties, ["s"])
    values = c.modes(counts)
    folded = {r["category"]: r["n"] for r in c.fold_missing(counts, values).collect()}
    imputed = c.impute_modes(ties, values, {"s": "im_s"})
    assert folded == {r["im_s"]: r["count"] for r in imputed.groupBy("im_s").count().collect()}


@pytest.mark.parametrize("small", [c.MAX_BROADCAST_ROWS, 1])
def test_index_order(spark, small):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None]], "s string")
    labels = c.index_labels(settle(c.category_counts(df, ["s"]), "t"), small)
    assert {r["category"]: r["position"] for r in labels.collect()} == {"c": 0, "a": 1, "b": 2}


def test_positions_over_many_slices(spark):
    df = spark.range(5000).select(
        (F.col("id") % 3).cast("string").alias("column"),
        F.md5(F.col("id").cast("string")).alias("category"),
        (F.col("id") % 7).alias("n"),
    )
    order = [F.desc("n"), F.asc("category")]
    rows = df.collect()
    expected = {}
    for group in "012":
        mine = sorted((r for r in rows if r["column"] == group), key=lambda r: (-r["n"], r["category"]))
        expected.update({(group, r["category"]): i for i, r in enumerate(mine)})
    found = c.positions(df, "column", order, "position").collect()
    assert {(r["column"], r["category"]): r["position"] for r in found} == expected


@pytest.fixture(scope="module")
def skewed(spark):
    """A third NULL, a third one value, and the rest spread over rare values."""
    value = (
        F.when(F.col("id") % 3 == 0, None)
        .when(F.col("id") % 3 == 1, F.lit("hot"))
        .otherwise(F.concat(F.lit("v"), F.col("id") % 301))
    )
    return spark.range(6000).select("id", value.alias("s"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("bounds", [{}, {"max_rows": 20}, {"max_bytes": 50}, {"max_rows": 0}])
def test_encoding_is_the_same_whatever_is_broadcast(spark, skewed, how, bounds):
    fitted = skewed.where("id < 4000")
    counts = settle(c.category_counts(fitted, ["s"]), "t")
    found = c.encode_frequency(skewed, counts, {"s": "f"}, how=how, **bounds)
    seen = Counter(r["s"] for r in fitted.collect())
    expected = {
        r["id"]: seen[r["s"]]
        for r in skewed.collect()
        if how == "left" or (r["s"] is not None and r["s"] in seen)
    }
    rows = found.collect()
    assert len(rows) == len(expected)
    assert {r["id"]: r["f"] for r in rows} == expected
    assert found.columns == ["id", "s", "f"]


def test_unseen_category_counts_zero(spark):
    fitted = spark.createDataFrame([("a",), ("b",)], "s string")
    counts = settle(c.category_counts(fitted, ["s"]), "t")
    row = c.encode_frequency(spark.createDataFrame([("zz",)], "s string"), counts, {"s": "f"}).first()
    assert row["f"] == 0


def test_index_of_null_and_unseen_is_null(spark):
    fitted = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    labels = settle(c.index_labels(settle(c.category_counts(fitted, ["s"]), "t")), "t")
    df = spark.createDataFrame([("b",), (None,), ("zz",)], "s string")
    found = {r["s"]: r["i"] for r in c.encode_index(df, labels, {"s": "i"}).collect()}
    assert found == {"b": 1, None: None, "zz": None}


def test_attach_rejects_other_joins(spark):
    with pytest.raises(ValueError):
        c.attach(spark.range(1), "id", spark.range(1), {}, how="outer")


@pytest.mark.parametrize("half", ["hot", None])
@pytest.mark.parametrize("how", ["left", "inner", "index"])
def test_hot_rows_are_spread(spark, half, how):
    """With the table too large to broadcast, no partition gets the rows of one value, or without one.

    The frame has the category column alone, so rows of one value are alike.
    """
    value = F.when(F.col("id") % 2 == 0, F.lit(half).cast("string")).otherwise(F.concat(F.lit("v"), F.col("id") % 997))
    df = spark.range(0, 40_000, 1, 8).select(value.alias("s"))
    counts = settle(c.category_counts(df, ["s"]), "t")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        if how == "index":
            found = c.encode_index(df, settle(c.index_labels(counts), "t"), {"s": "f"}, max_rows=20)
        else:
            found = c.encode_frequency(df, counts, {"s": "f"}, how=how, max_rows=20)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        total = found.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert total == (20_000 if how == "inner" and half is None else 40_000)
    assert max(sizes) <= 2 * total / 8


def test_modes_of_an_empty_column_are_named(spark):
    df = spark.createDataFrame([(None,), (None,)], "s string")
    values = c.modes(c.category_counts(df, ["s"]))
    with pytest.raises(ValueError, match="no value to impute from in .'s'"):
        c.impute_modes(df, values, {"s": "t"})
    assert c.impute_modes(df, {"s": "x"}, {"s": "t"}).first()["t"] == "x"


def test_means_of_an_empty_column_fail_or_take_the_default(spark):
    from sparkprep.operators import numeric

    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    with pytest.raises(Exception, match="no values to average"):
        numeric.impute_means(df, {"x": "y"}).collect()
    assert [r["y"] for r in numeric.impute_means(df, {"x": "y"}, default=1.5).collect()] == [1.5, 1.5]
    assert numeric.impute_means(df.limit(0), {"x": "y"}, default=0.0).count() == 0
