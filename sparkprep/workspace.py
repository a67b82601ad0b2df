"""Intermediate tables, written to the folder every executor shares.

Fitted state (category counts, label positions, cut points) is written once as parquet and read
back. That cuts lineage in a way that survives lost executors, and it gives the planner the real
size of the table, so it broadcasts what is below ``spark.sql.autoBroadcastJoinThreshold`` and
shuffles the rest.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for an unset local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="sparkprep-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def _session_folder(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/sparkprep-{application}"


_open_scopes: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for held in _open_scopes[-1:]:
        held.append(path)
    return path


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of what is settled inside, for deleting it later."""
    held: list[str] = []
    _open_scopes.append(held)
    try:
        yield held
    finally:
        _open_scopes.pop()  # by place: scopes that hold nothing yet are equal


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is settled inside when the block ends, also after a failure."""
    with noted() as held:
        try:
            yield
        finally:
            for path in held:
                discard(spark, path)


_settled: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
"""Where each settled table was written."""

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of each query inside once it has ended.

    Without that they stay until the driver happens to collect its garbage. A lost file is made anew.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    Its shuffle files go when the table is written, as nothing will read them again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with _shuffles_released(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _settled[table] = path
    return table


def settle_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Settle what ``make`` returns, and delete what it has settled on the way."""
    with noted() as held:
        try:
            df = make()
        except BaseException:
            for path in held:
                discard(spark, path)
            raise
    try:
        return settle(df, name)
    finally:
        for path in held:
            discard(spark, path)


def release(*tables: DataFrame) -> None:
    """Delete settled tables that nothing will read any more."""
    for table in tables:
        discard(table.sparkSession, _settled.pop(table))


def _hadoop(spark: SparkSession, path: str):
    """A path and the file system it is on."""
    context = spark.sparkContext
    located = context._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(context._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    located, files = _hadoop(spark, path)
    return files.exists(located)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files right in a folder."""
    located, files = _hadoop(spark, path)
    names = [f.getPath().getName() for f in files.listStatus(located)] if files.exists(located) else []
    return [n for n in names if not n.startswith(("_", "."))]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table, if it is there."""
    located, files = _hadoop(spark, path)
    files.delete(located, True)


def discard_settled(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. DataFrames that still read them will fail."""
    located, files = _hadoop(spark, _session_folder(spark))
    files.delete(located, True)
