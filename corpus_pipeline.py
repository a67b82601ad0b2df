"""The corpus pipeline: documents through five stages, each written and read again.

Quality rules, line dedup, near-duplicate removal, benchmark decontamination, tokenisation. Every stage
works on all rows that the one before has kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.bpe import encode_documents, vocabulary_path
from sparkprep.llm.common import documents, ship
from sparkprep.llm.decontaminate import find_contamination
from sparkprep.llm.line_templates import drop_recurring_lines
from sparkprep.llm.quality import judge
from sparkprep.llm.shingle_join import similar_groups
from sparkprep.workspace import discard, noted, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

_left: list[str] = []
"""Intermediate tables of the stage before."""


def stage(function: Stage) -> Stage:
    """A stage that first deletes the intermediate tables of the one before.

    What a stage returns is lazy and reads them, so they can go only when it has been written; it has
    been when the next stage begins, which is given the written table. Columns that documents do not
    have are given other names inside, so none clashes with what an operator adds.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            discard(spark, _left.pop())
        inside = {c: c if c in COLUMNS else f"given__{k}" for k, c in enumerate(docs.columns)}
        outside = {new: c for c, new in inside.items()}
        with noted() as held:
            found = function(spark, docs.select(*(F.col(f"`{c}`").alias(n) for c, n in inside.items())), sf_dir)
        _left.extend(held)
        return found.select(*(F.col(c).alias(outside.get(c, c)) for c in found.columns))

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return judge(docs).where("kept").select(*docs.columns)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines of recurring templates; ``n_chars`` follows the text."""
    found = drop_recurring_lines(docs)
    changed = F.size("dropped") > 0
    new = {
        "text": F.col("kept_text"),
        "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")),
    }
    return found.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of similar ones.

    Of several rows with its id and text, the one that is least by its other columns.
    """
    ship(spark)
    staying = similar_groups(docs).where("stays").select(
        F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")
    )
    held = docs.withColumn("_hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_hash") == F.col("_text_hash"))
    kept = held.join(staying.distinct(), same)
    others = F.struct(*(c for c in docs.columns if c != "text"))
    one = kept.groupBy("_doc_id", "_hash").agg(F.min(others).alias("_least"), F.first("text").alias("text"))
    return one.select(*(F.col("text") if c == "text" else F.col("_least")[c].alias(c) for c in docs.columns))


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    ship(spark)
    found = find_contamination(docs, documents(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select(*docs.columns)


@stage
def tokenisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    ship(spark)
    found = encode_documents(docs, vocabulary_path(), keep=("doc_id", "lang", "source"))
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", tokenisation),
]

# Near-duplicate groups and the encoding are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what each returns is written and read again."""
    docs = documents(spark, sf_dir)
    last = None
    for name, work in STAGES:
        with noted() as made:  # the stage notes its own tables, so this is what it was written to
            docs = settle(work(spark, docs, sf_dir), f"pipeline-{name}")
        if last:
            discard(spark, last)
        (last,) = made
    return docs
