from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.operators.profile import missing_report
from sparkprep.sources.landing import CORRUPT, corrupt, landing_schema, unwrap
from sparkprep.sources.store import append_to_store, read_if_present, sorted_records
from sparkprep.workspace import discard

BatchWork = Callable[[DataFrame, int], None]


def stream_landing(
    spark: SparkSession,
    path: str,
    payload: T.StructType,
    whole_files: bool = False,
    max_files: int = 1000,
) -> DataFrame:
    """Landed files as a stream, at most ``max_files`` to a micro-batch."""
    return (
        spark.readStream.schema(landing_schema(payload))
        .option("multiLine", whole_files)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", max_files)
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("_file"))
    )


def load_new_files(landed: DataFrame, target: str, checkpoint: str) -> None:
    """Append the payloads of files not loaded before to ``target``, then stop.

    The checkpoint and the sink's own log make each file count once, across restarts too.
    """
    query = (
        unwrap(landed)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stage_new_files(
    landed: DataFrame, staging: str, checkpoint: str, with_batch: BatchWork | None = None
) -> DataFrame | None:
    """Parse files not read before into ``staging`` and return all that is staged, None if nothing is.

    The checkpoint remembers the files, and what they held stays in ``staging`` until the caller has
    loaded and deleted it: a load that fails in between finds it there. A micro-batch that runs again
    overwrites its own part. ``with_batch`` gets each staged micro-batch and its number.
    """
    spark = landed.sparkSession

    def stage(batch: DataFrame, batch_id: int) -> None:
        path = f"{staging}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        if with_batch:
            with_batch(spark.read.schema(landed.schema).parquet(path), batch_id)

    query = (
        landed.writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_if_present(spark, staging, landed.schema)


def stream_to_store(
    landed: DataFrame,
    checkpoint: str,
    *,
    root: str,
    store: str,
    key: str,
    received: str,
    min_start: date | None = None,
) -> None:
    """Load new files into the feature store, with the same side tables as a batch load.

    Under ``root``: ``quarantine`` and ``profiles``, a part for each micro-batch, and ``unkeyed``,
    ``undated`` and ``early``, a part for each load that had such records. Micro-batches are staged;
    the store is looked at once, when all are in. A load that is repeated after a failure adds nothing.
    """

    def side_tables(batch: DataFrame, batch_id: int) -> None:
        corrupt(batch).write.mode("overwrite").parquet(f"{root}/quarantine/batch_id={batch_id}")
        report = missing_report(unwrap(batch))
        report.write.mode("overwrite").parquet(f"{root}/profiles/batch_id={batch_id}")

    spark, staging = landed.sparkSession, f"{root}/staging"
    staged = stage_new_files(landed, staging, checkpoint, side_tables)
    if staged is None:
        return
    parts = sorted_records(unwrap(staged), key, received, min_start)
    append_to_store(parts.pop("store"), store, key, received)
    last = spark.read.parquet(staging).agg(F.max("batch_id")).first()[0]
    for name, part in parts.items():
        part.write.mode("overwrite").parquet(f"{root}/{name}/through={last or 0}")
    discard(spark, staging)
