"""How far loading has come: a table with one row per finished load."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.workspace import exists

SCHEMA = "from_date date, to_date date, data_file_path string"


def watermarks(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def latest(spark: SparkSession, path: str) -> date | None:
    """Upper bound of the last finished load."""
    return watermarks(spark, path).agg(F.max("to_date")).first()[0]


def advance(spark: SparkSession, path: str, first: date, last: date, data_file_path: str) -> None:
    """Record a finished load. Call it only after the data write has committed."""
    row = spark.createDataFrame([(first, last, data_file_path)], SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)
