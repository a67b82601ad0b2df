"""Word counts, hashed word counts and TF-IDF over a text column."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sparkprep.functions import column, stored_entries, tokens
from sparkprep.operators.categories import attach
from sparkprep.workspace import settle


def tokenise(df: DataFrame, text: str, output: str = "words") -> DataFrame:
    return df.withColumn(output, tokens(column(text)))


TASK_TEXT_BYTES = 16 << 20
"""Bytes of text whose words one task counts: more text takes more tasks, not more memory a task."""


def term_frequencies(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, term, tf)``, without the empty term, given one row per key.

    The raw text is shuffled by key, which is less data than the words it splits into. Spark then
    finds the words already clustered by key and term and counts them without another shuffle. The
    shuffle has a partition for every ``TASK_TEXT_BYTES`` of text at least.
    """
    given = df.select(column(key), column(text))
    size = given.agg(F.sum(F.octet_length(column(text)))).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = -(-size // TASK_TEXT_BYTES)
    dealt = given.repartition(tasks, column(key)) if tasks > least else given.repartition(column(key))
    words = (
        dealt
        .select(column(key), F.explode(tokens(column(text))).alias("term"))
        .where(F.col("term") != "")
    )
    return words.groupBy(column(key), "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(df: DataFrame, text: str) -> DataFrame:
    """``(category, n)``: how many texts hold each term.

    Repeats go inside the row, so only counted terms are shuffled, not pairs of key and term.
    """
    terms = df.select(F.explode(F.array_distinct(tokens(column(text)))).alias("category"))
    return (
        terms.where(F.col("category") != "")
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def tfidf_terms(df: DataFrame, key: str, text: str, **bounds) -> DataFrame:
    """``(key, term, tf, df, idf, tfidf)`` with ``idf = ln((documents + 1) / (df + 1))``.

    Stop words are the hot keys of the lookup. The document frequencies tell which they are, so
    :func:`attach` broadcasts them and shuffles the long tail when the vocabulary is large.
    """
    counted = Observation()
    vocabulary = document_frequencies(df.observe(counted, F.count(F.lit(1)).alias("documents")), text)
    vocabulary = settle(vocabulary, "document-frequencies")
    documents = F.lit(counted.get["documents"]).cast("double")
    found = attach(term_frequencies(df, key, text), "term", vocabulary, {"n": "df"}, **bounds)
    idf = F.log((documents + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    return found.withColumn("idf", idf).withColumn("tfidf", F.col("tf") * F.col("idf"))


def hashed_frequencies(df: DataFrame, key: str, text: str, buckets: int = 40) -> DataFrame:
    """``(key, bucket, tf)`` of the non-zero entries of the hashed word-count vector."""
    filled = df.select(column(key), F.coalesce(column(text), F.lit("")).alias("_text"))
    words = Tokenizer(inputCol="_text", outputCol="_words").transform(filled)
    vectors = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=buckets).transform(words)
    return (
        vectors.select(column(key), F.explode(stored_entries("_tf")).alias("_entry"))
        .select(column(key), F.col("_entry.position").alias("bucket"), F.col("_entry.value").alias("tf"))
        .where(F.col("tf") > 0)
    )
