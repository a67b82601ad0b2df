"""Secret scans in DataFrame operations only.

Base patterns find assignments, access keys and hex strings. Beyond them, long tokens are compared
under two character Markov models, one of random strings and one of ordinary identifiers, by the
log-likelihood ratio per character pair. The models are counted from labelled samples: values that the
base patterns found are random, words of letters only are ordinary.
"""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import documents, dropping
from sparkprep.workspace import settle

# The patterns, and how long a match must be. The first alternative of `assign` is in
# either case; its value is what follows the last separator.
ASSIGN = (
    r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+"
)
ASSIGN_VALUE = (
    r"^(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-"
CANDIDATE = "[A-Za-z0-9+/_=-]{16,}"
ORDINARY = "(?<![A-Za-z0-9+/_=-])[A-Za-z]{6,}(?![A-Za-z0-9+/_=-])"

BACK_OFF = 5.0
"""So many counts the single characters weigh beside the pairs."""

ADDED = ("found",)
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def matches(text: Column, pattern: str, kind: int, value_pattern: str | None = None) -> Column:
    """All leftmost matches with their places: gaps between them are what splitting leaves."""
    hits = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.split(text, pattern, -1)
    sizes = F.zip_with(
        F.slice(gaps, 1, F.size(hits)),
        hits,
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit"), hit.alias("value")),
    )
    start = F.struct(F.lit(0).alias("end"), F.lit(None).cast(SPAN).alias("found"))

    def step(state: Column, size: Column) -> Column:
        first = state["end"] + size["gap"]
        value = size["value"] if value_pattern is None else F.regexp_extract(size["value"], value_pattern, 1)
        span = F.struct(
            first.alias("start"),
            F.lit(kind).alias("kind"),
            (first + size["hit"]).alias("end"),
            value.alias("value"),
        )
        held = F.coalesce(state["found"], F.array().cast(SPAN))
        return F.struct(
            (first + size["hit"]).alias("end"),
            F.concat(held, F.array(span)).cast(SPAN).alias("found"),
        )

    found = F.aggregate(sizes, start, step)["found"]
    none = F.array().cast(SPAN)
    return F.when(text.rlike(pattern), F.coalesce(found, none)).otherwise(none)


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``_base``, the spans of the base patterns, and ``_more``, tokens for the models to judge."""
    held = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    t = F.col("_text")
    long_enough = lambda kind: lambda x: F.length(x["value"]) >= LEAST[kind]
    # Longer runs can be looked for at once where only a run's length decides: runs are disjoint.
    return held.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.concat(
            F.filter(matches(t, ASSIGN, 0, ASSIGN_VALUE), long_enough("assign")),
            F.filter(matches(t, f"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}", 1), long_enough("access")),
            F.filter(matches(t, f"[0-9a-f]{{{LEAST['hex']},}}", 2), long_enough("hex")),
        ).alias("_base"),
        matches(t, CANDIDATE, 3).alias("_more"),
    )


def ordinary_words(docs: DataFrame, text: str, sample_docs: int) -> DataFrame:
    """Words of letters only from about ``sample_docs`` documents, chosen by a hash of the text."""
    total = docs.count()
    share = min(1.0, sample_docs / max(total, 1))
    chosen = F.pmod(F.xxhash64(F.col(text)), F.lit(1_000_003)) <= F.lit(int(share * 1_000_003))
    words = F.regexp_extract_all(F.col(text), F.lit(f"({ORDINARY})"), F.lit(1))
    return docs.where(chosen & F.col(text).isNotNull()).select(F.explode(words).alias("value"))


def _indices(value: Column) -> Column:
    """Places of the characters in the alphabet, from 1; 0 for any other."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.call_function("instr", F.lit(ALPHABET), c))


def _pairs(value: Column) -> Column:
    """Neighbouring characters as numbers ``(a - 1) * size + b``; pairs with other characters go."""
    places = _indices(value)
    n = F.size(places)
    before = F.slice(places, 1, F.greatest(n - 1, F.lit(0)))
    after = F.slice(places, 2, F.greatest(n - 1, F.lit(0)))
    size = len(ALPHABET)
    joined = F.zip_with(
        before, after, lambda a, b: F.when((a > 0) & (b > 0), (a - 1) * size + b).otherwise(0)
    )
    return F.filter(joined, lambda p: p > 0)


def fit_ratios(random: DataFrame, ordinary: DataFrame) -> list[float]:
    """Log-likelihood ratios of all character pairs, from samples in a column ``value``.

    Each model is a table of pair counts. A pair seen rarely leans on how frequent its second character
    is, with one added to each, so no pair is impossible and a model without a sample is uniform. What
    comes to the driver is one number for each pair of the alphabet.
    """
    size = len(ALPHABET)
    both = random.select(F.lit(1).alias("label"), "value").unionByName(
        ordinary.select(F.lit(0).alias("label"), "value")
    )
    pairs = both.select("label", F.explode(_pairs(F.col("value"))).alias("pair"))
    counted = pairs.groupBy("label", "pair").count().collect()
    counts = np.zeros((2, size * size))
    for r in counted:
        counts[r["label"], r["pair"] - 1] = r["count"]
    counts = counts.reshape(2, size, size)
    after = counts.sum(axis=1, keepdims=True) + 1
    single = after / after.sum(axis=2, keepdims=True)
    shares = (counts + BACK_OFF * single) / (counts.sum(axis=2, keepdims=True) + BACK_OFF)
    return np.log(shares[1] / shares[0]).ravel().tolist()


def scan_secrets(
    docs: DataFrame,
    text: str = "text",
    least_ratio: float = 0.7,
    sample_docs: int = 2_000,
) -> DataFrame:
    """``docs`` without the text, with ``found``: spans of secrets by start, then kind.

    A span has ``start`` and ``end`` (code points, end exclusive), ``kind`` (a place in ``KINDS``) and
    ``value``. A token that no base span touches is added as ``markov`` if its log-likelihood ratio is
    ``least_ratio`` per pair or more. NULL and empty texts have no spans. ``sample_docs`` bounds the
    documents whose words teach the model of ordinary strings; all base values teach the other.
    """
    docs = dropping(docs, *ADDED)
    kept = [c for c in docs.columns if c != text]
    based = settle(with_base(docs, text).drop(text), "secret-spans")
    values = based.select(F.explode("_base").alias("s")).select(F.col("s.value").alias("value"))
    ratios = fit_ratios(values, ordinary_words(docs, text, sample_docs))
    table = F.split(F.lit(",".join(f"{x:.9g}" for x in ratios)), ",").cast("array<double>")
    base = F.col("_base")

    def random(span: Column) -> Column:
        pairs = _pairs(span["value"])
        total = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.get(table, p - 1))
        return total >= least_ratio * F.greatest(F.size(pairs), F.lit(1))

    def free(span: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))

    more = F.filter("_more", lambda s: free(s) & random(s))
    found = F.sort_array(F.concat(base, more))
    return based.select(*(F.col(f"`{c}`") for c in kept), found.alias("found"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of base spans, their digest, and all spans of each document."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")
    found = scan_secrets(docs)

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("found")).alias("spans"),
        count(3).alias("n_markov"),
    )
