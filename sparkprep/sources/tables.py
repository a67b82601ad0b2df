"""The star-schema tables, and the complaint-shaped view of them that the queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEW_COLUMNS = (
    "complaint_id",
    "date_received",
    "date_sent_to_company",
    "company_response",
    "company_public_response",
    "consumer_consent_provided",
    "submitted_via",
    "issue",
    "consumer_disputed",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def complaints(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Orders seen as complaints, with NULLs set by key.

    Customers, parts and shipments are joined only where the asked columns need them: each has one
    row per order at most, so leaving a join out changes no row.
    """
    columns = columns or VIEW_COLUMNS
    key = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    segment = F.col("c_mktsegment")
    values = {
        "complaint_id": key,
        "date_received": F.col("o_orderdate"),
        "date_sent_to_company": F.col("first_ship"),
        "company_response": F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")),
        "company_public_response": F.when(
            ~(key % 10 < 6), F.nullif(segment, F.lit("HOUSEHOLD"))
        ),
        "consumer_consent_provided": F.nullif(segment, F.lit("MACHINERY")),
        "submitted_via": F.when(key % 7 != 0, status),
        "issue": F.col("p_name"),
        "consumer_disputed": F.when(status == "F", "Yes").when(status == "O", "No"),
    }
    df = table(spark, sf_dir, "orders")
    if {"date_sent_to_company", "issue"} & set(columns):
        firsts = [F.min("l_shipdate").alias("first_ship"), F.min("l_partkey").alias("first_part")]
        shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*firsts)
        df = df.join(shipped, df["o_orderkey"] == shipped["l_orderkey"], "left")
    if {"company_public_response", "consumer_consent_provided"} & set(columns):
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
        df = df.join(customer, df["o_custkey"] == customer["c_custkey"], "left")
    if "issue" in columns:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
        df = df.join(part, df["first_part"] == part["p_partkey"], "left")
    return df.select(*(values[c].alias(c) for c in columns))
