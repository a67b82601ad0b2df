"""Splits, shuffles and samples by the digest of a row's key.

The key must be unique for the exact sizes below; rows that share a key share their fate.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.functions import column, digest_bucket, key_digest
from sparkprep.operators.categories import attach
from sparkprep.workspace import settle

SPLIT_STEPS = 1000


def in_train(key: str, test_size: float = 0.3) -> Column:
    """Whether a row belongs to the training side. A map-side predicate: no sort, no shuffle."""
    step = F.conv(F.substring(key_digest(key), 1, 8), 16, 10).cast("long") % SPLIT_STEPS
    return step < round((1 - test_size) * SPLIT_STEPS)


def split(df: DataFrame, key: str, test_size: float = 0.3) -> tuple[DataFrame, DataFrame]:
    side = in_train(key, test_size)
    return df.where(side), df.where(~side)


def random_split(df: DataFrame, test_size: float = 0.3, seed: int | None = None) -> list[DataFrame]:
    """Spark's own split, for tables without a key; it varies with partitioning even when seeded."""
    return df.randomSplit([1 - test_size, test_size], seed)


def shuffle_rank(df: DataFrame, key: str, salt: str = "", output: str = "position") -> DataFrame:
    """Number rows from 1 in the order of their salted key digests.

    A row's number is its rank within its digest bucket plus the sizes of the earlier buckets.
    There are 65,536 even buckets, so no task sees more than that share of the rows, and the
    broadcast offsets and the window over them hold 65,536 rows at most.
    """
    digest = key_digest(key, salt)
    marked = df.withColumn("_digest", digest).withColumn("_bucket", digest_bucket(F.col("_digest")))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.select(digest_bucket(digest).alias("_bucket"))
        .groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_bucket").orderBy("_digest", column(key))
    return (
        marked.join(F.broadcast(offsets), "_bucket")
        .withColumn(output, F.row_number().over(within) + F.col("_offset"))
        .drop("_digest", "_bucket", "_offset")
    )


def shuffled(df: DataFrame, key: str, salt: str = "") -> DataFrame:
    """Rows in the order of their salted key digests: a range-partitioned sort of distinct keys."""
    return df.orderBy(key_digest(key, salt), column(key))


def _digests(df: DataFrame, key: str, *labels: Column) -> DataFrame:
    digests = df.select(*labels, key_digest(key).alias("digest"))
    return digests.withColumn("bucket", digest_bucket(F.col("digest")))


def take(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """The ``n`` rows with the lowest key digests, or all rows for ``None``.

    A histogram over digest buckets finds the bucket in which ``n`` runs out, and sorting that one
    bucket finds the digest. The limit so becomes a plain filter, instead of a sort whose last step
    runs in one task.
    """
    if n is None:
        return df
    digests = _digests(df, key)
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        digests.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("size"))
        .withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .where(F.col("before") < n)
        .orderBy(F.desc("bucket"))
        .first()
    )
    if last is None:
        return df.limit(0)
    lowest = digests.where(F.col("bucket") == last["bucket"]).orderBy("digest")
    cut = lowest.limit(n - last["before"]).agg(F.max("digest")).first()[0]
    return df.where(key_digest(key) <= cut)


def _class_cuts(df: DataFrame, key: str, label: str) -> DataFrame:
    """``(category, n, cut)``: each class's size and the digest within which it has as many rows
    as the smallest class. Found as in :func:`take`, for all the classes at once."""
    digests = _digests(df, key, column(label).cast("string").alias("category"))
    sizes = settle(
        digests.groupBy("category", "bucket").agg(F.count(F.lit(1)).alias("size")), "digest-sizes"
    )
    totals = sizes.groupBy("category").agg(F.sum("size").alias("n"))
    quota = totals.agg(F.min("n")).first()[0] or 0
    earlier = (
        Window.partitionBy("category").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    cut_buckets = settle(
        sizes.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .groupBy("category")
        .agg(
            F.sum("size").alias("n"),
            F.max(F.when(F.col("before") < quota, F.struct("bucket", "before"))).alias("last"),
        )
        .select("category", "n", F.col("last.bucket").alias("last_bucket"), "last.before"),
        "digest-cuts",
    )
    ranked = Window.partitionBy("category").orderBy("digest")
    at_cut = (
        attach(digests, "category", cut_buckets, {"last_bucket": "last_bucket", "before": "before"})
        .where(F.col("bucket") == F.col("last_bucket"))
        .withColumn("rank", F.row_number().over(ranked) + F.col("before"))
        .where(F.col("rank") <= quota)
        .groupBy("category")
        .agg(F.max("digest").alias("cut"))
    )
    return settle(cut_buckets.select("category", "n").join(at_cut, "category"), "class-cuts")


def balance(df: DataFrame, key: str, label: str) -> DataFrame:
    """Undersample every class to the size of the smallest; rows without a label are left out.

    The sample is a filter too: each class has a threshold digest, and the rows at or below it stay.
    """
    known = df.where(column(label).isNotNull())
    cuts = _class_cuts(known, key, label)
    marked = attach(known, label, cuts, {"cut": "_cut"})
    return marked.where(key_digest(key) <= F.col("_cut")).drop("_cut")


def balance_approx(df: DataFrame, label: str, seed: int) -> DataFrame:
    """Near-equal class sizes from independent draws per row, for tables without a key."""
    counts = {
        r["label"]: r["n"]
        for r in df.where(column(label).isNotNull())
        .groupBy(column(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    least = min(counts.values(), default=0)
    fractions = {value: least / n for value, n in counts.items()}
    return df.where(column(label).isNotNull()).sampleBy(label, fractions, seed)


def union_by_name(parts: Iterable[DataFrame]) -> DataFrame:
    """All parts in one table, matched by column name; a column some part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
