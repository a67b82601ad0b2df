import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkprep.operators import sampling as s


def digest(key, salt=""):
    return hashlib.md5(f"{salt}{'' if key is None else key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def rows(spark):
    """Half of one class, a third of another, some rare, and some without a label."""
    label = (
        F.when(F.col("id") % 2 == 0, "a")
        .when(F.col("id") % 3 == 0, "b")
        .when(F.col("id") % 5 == 0, None)
        .otherwise("c")
    )
    return spark.range(3000).select("id", label.alias("label"))


def test_split_is_disjoint_complete_and_stable(rows):
    train, test = s.split(rows, "id")
    ids = {r["id"] for r in train.collect()}
    rest = {r["id"] for r in test.collect()}
    assert not ids & rest
    assert len(ids | rest) == 3000
    assert 0.65 < len(ids) / 3000 < 0.75
    again, _ = s.split(rows.repartition(7), "id")
    assert {r["id"] for r in again.collect()} == ids


def test_split_places_null_keys(spark):
    df = spark.createDataFrame([(None,), ("x",)], "k string")
    train, test = s.split(df, "k")
    assert train.count() + test.count() == 2


def test_split_needs_no_shuffle(rows):
    plan = s.split(rows, "id")[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_random_split_is_complete(rows):
    parts = s.random_split(rows, 0.3, seed=5)
    assert sum(p.count() for p in parts) == 3000


def test_shuffle_rank_matches_a_sort(rows):
    found = {r["id"]: r["position"] for r in s.shuffle_rank(rows, "id", salt="q").collect()}
    order = sorted(range(3000), key=lambda i: (digest(i, "q"), i))
    assert found == {i: n for n, i in enumerate(order, 1)}


def test_shuffled_order(rows):
    found = [r["id"] for r in s.shuffled(rows, "id").collect()]
    assert found == sorted(range(3000), key=digest)


@pytest.mark.parametrize("n", [0, 1, 1234, 3000, 99999])
def test_take_is_exact(rows, n):
    found = {r["id"] for r in s.take(rows, "id", n).collect()}
    assert found == set(sorted(range(3000), key=digest)[:n])


def test_take_without_limit(rows):
    assert s.take(rows, "id", None) is rows


def test_take_of_nothing(spark):
    assert s.take(spark.range(0), "id", 5).count() == 0


def test_balance_is_exact(rows):
    found = s.balance(rows, "id", "label").collect()
    known = [r for r in rows.collect() if r["label"] is not None]
    groups = {}
    for r in known:
        groups.setdefault(r["label"], []).append(r["id"])
    least = min(len(g) for g in groups.values())
    expected = {i for g in groups.values() for i in sorted(g, key=digest)[:least]}
    assert {r["id"] for r in found} == expected
    assert len(found) == len(groups) * least


def test_balance_is_stable_under_repartition(rows):
    a = {r["id"] for r in s.balance(rows, "id", "label").collect()}
    b = {r["id"] for r in s.balance(rows.repartition(5), "id", "label").collect()}
    assert a == b


def test_balance_with_no_labels(spark):
    df = spark.createDataFrame([(1, None)], "id int, label string")
    assert s.balance(df, "id", "label").count() == 0


def test_balance_approx(rows):
    counts = [r["count"] for r in s.balance_approx(rows, "label", 3).groupBy("label").count().collect()]
    assert len(counts) == 3
    assert max(counts) < 1.3 * min(counts)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.sets(st.text(max_size=4), min_size=1, max_size=30),
    n=st.integers(min_value=0, max_value=35),
)
def test_take_on_any_keys(spark, keys, n):
    clean = {k for k in keys if k.encode("utf-8", "ignore").decode() == k}
    if not clean:
        return
    df = spark.createDataFrame([(k,) for k in clean], "k string")
    assert {r["k"] for r in s.take(df, "k", n).collect()} == set(sorted(clean, key=digest)[:n])


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    c = spark.createDataFrame([(3,)], "i int")
    found = {(r["i"], r["s"]) for r in s.union_by_name([a, b, c]).collect()}
    assert found == {(1, "x"), (2, "y"), (3, None)}
