"""Landed JSON records, their envelope, and what cannot be parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions import as_timestamp, column
from sparkprep.schema import SchemaSpec

ENVELOPE = "_source"
CORRUPT = "_corrupt_record"


def landing_schema(payload: T.StructType) -> T.StructType:
    """Schema of landed files: the payload in its envelope, and the text of unparsable records."""
    return T.StructType(
        [T.StructField(ENVELOPE, payload), T.StructField(CORRUPT, T.StringType())]
    )


def read_landing(
    spark: SparkSession, path: str, payload: T.StructType, whole_files: bool = False
) -> DataFrame:
    """All landed files under ``path`` in one scan, with the given schema and the file's name.

    Every line is a record of its own, which Spark can split across tasks. ``whole_files`` reads each
    file as one JSON document, as an array of records is, in one task.
    """
    return (
        spark.read.schema(landing_schema(payload))
        .option("multiLine", whole_files)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("_file"))
    )


def unwrap(landed: DataFrame) -> DataFrame:
    """Payloads of the sound records that have one."""
    sound = F.col(ENVELOPE).isNotNull() & F.col(CORRUPT).isNull()
    return landed.where(sound).select(f"{ENVELOPE}.*")


def unwrap_text(df: DataFrame, text: str, payload: T.StructType, *keep: str) -> DataFrame:
    """Payloads of JSON documents held in a column, next to the columns in ``keep``."""
    parsed = F.from_json(column(text), landing_schema(payload), {"columnNameOfCorruptRecord": CORRUPT})
    return (
        df.select(*(column(c) for c in keep), parsed.alias("_landed"))
        .where(F.col(f"_landed.{ENVELOPE}").isNotNull())
        .select(*(column(c) for c in keep), f"_landed.{ENVELOPE}.*")
    )


def corrupt(landed: DataFrame) -> DataFrame:
    """``(file, content, partly_parsed)`` of what was not JSON or did not fit the schema.

    Spark refuses to scan for the corrupt column alone, so the filter always reads the envelope too.
    """
    payload_read = F.col(ENVELOPE).isNull() | F.col(ENVELOPE).isNotNull()
    return landed.where(F.col(CORRUPT).isNotNull() & payload_read).select(
        F.col("_file").alias("file"),
        F.col(CORRUPT).alias("content"),
        F.col(ENVELOPE).isNotNull().alias("partly_parsed"),
    )


def outcome_counts(landed: DataFrame) -> DataFrame:
    """``(outcome, n)``: records that parsed, were skipped for lack of a payload, or are corrupt."""
    outcome = (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("corrupt"))
        .when(F.col(ENVELOPE).isNull(), F.lit("no payload"))
        .otherwise(F.lit("parsed"))
    )
    return landed.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def typed(df: DataFrame, spec: SchemaSpec) -> DataFrame:
    """Cast the declared columns to their types; malformed dates become NULL."""
    casts = {
        f.name: as_timestamp(f.name)
        for f in spec.declared
        if f.dataType == T.TimestampType() and f.name in df.columns
    }
    return df.withColumns(casts)
