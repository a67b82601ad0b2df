"""The feature store and the write-once and append sinks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions import as_timestamp, column
from sparkprep.sources.key_index import KeyIndex
from sparkprep.workspace import exists, settle

MONTH = "received_month"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet files whose columns may have grown over time, read with all of them.

    Without a ``schema`` Spark has to open every file's footer to learn it.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    return read_table(spark, path, schema) if exists(spark, path) else None


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One record per key: the greatest by column order, so the choice is repeatable.

    Keys are counted first, which moves keys only; records are compared for the keys that repeat.
    Rows without a key are left out. ``df`` is read three times and should be a table.
    """
    keyed = df.where(column(key).isNotNull())
    counted = keyed.groupBy(column(key)).agg(F.count(F.lit(1)).alias("_n"))
    repeated = settle(counted.where("_n > 1").select(column(key)), "repeated-keys")
    others = [column(c) for c in df.columns if c != key] or [column(key)]
    picked = (
        keyed.join(repeated, key, "left_semi")
        .groupBy(column(key))
        .agg(F.max(F.struct(*others)).alias("_record"))
    )
    if df.columns != [key]:
        picked = picked.select(column(key), "_record.*")
    picked = picked.select(*(column(c) for c in df.columns))
    return keyed.join(repeated, key, "left_anti").select(*(column(c) for c in df.columns)).unionAll(picked)


def unseen(
    df: DataFrame, stored: DataFrame, key: str, offered: DataFrame | None = None
) -> DataFrame:
    """Rows whose key a table without an index lacks.

    The stored keys are first cut down to those in ``df`` (or ``offered``, a table with at least the
    same keys). With a batch that is small enough to broadcast, the store is read map-side, one column
    of it, and is never shuffled.
    """
    keys = (df if offered is None else offered).select(column(key))
    seen = stored.select(column(key)).join(keys, key, "left_semi")
    return df.join(seen, key, "left_anti")


def index_path(path: str) -> str:
    """Where the index of a store's keys is."""
    return f"{path.rstrip('/')}_keys"


def append_to_store(df: DataFrame, path: str, key: str, received: str) -> None:
    """Append new records, partitioned by month of receipt, in one write.

    Records already stored are skipped, so loading a batch twice equals loading it once. They are found
    by the store's :class:`KeyIndex`, which lies beside it: the store itself is not read, unless the index
    is missing or an earlier load has left it unfinished. Records without a key can't be told apart and
    are left out; :func:`sorted_records` names them. The rebalance hint makes Spark split a month that
    is too large for one task and join small ones. A batch with no new record writes nothing.
    """
    spark, field = df.sparkSession, df.schema[key]
    batch = settle(df.where(column(key).isNotNull()), "batch")
    fresh = settle(one_per_key(batch, key), "one-per-key")
    index = KeyIndex(spark, index_path(path), field)
    if not index.is_sound():
        stored = read_if_present(spark, path, T.StructType([field]))
        index.write_anew(fresh.limit(0) if stored is None else stored)
    fresh = settle(index.unseen(fresh), "fresh")
    if fresh.isEmpty() and exists(spark, path):
        return
    index.begin()
    month = F.date_format(F.trunc(as_timestamp(received), "month"), "yyyy-MM")
    (
        fresh.withColumn(MONTH, month)
        .hint("rebalance", MONTH)
        .write.mode("append")
        .partitionBy(MONTH)
        .parquet(path)
    )
    index.add(fresh)


def sorted_records(
    df: DataFrame, key: str, received: str, min_start: date | None = None
) -> dict[str, DataFrame]:
    """Where each record belongs: ``store``, ``unkeyed``, ``undated`` or ``early``; each in one of them.

    ``early`` are records received before ``min_start``. Nothing is dropped on the way to the store
    without being in one of the other tables.
    """
    has_key, moment = column(key).isNotNull(), as_timestamp(received)
    early = moment < F.lit(min_start) if min_start else F.lit(False)
    return {
        "store": df.where(has_key & moment.isNotNull() & ~early),
        "unkeyed": df.where(~has_key),
        "undated": df.where(has_key & moment.isNull()),
        "early": df.where(has_key & moment.isNotNull() & early),
    }


def write_once(df: DataFrame, path: str) -> int:
    """Write to a path that must not exist yet, and return the number of rows written.

    The rows are counted as they are written, without a job of their own.
    """
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("n_rows"))
    counted.write.mode("errorifexists").parquet(path)
    return written.get["n_rows"]


def append_rejects(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
