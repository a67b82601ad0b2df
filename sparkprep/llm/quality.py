"""Quality rules by distribution divergence, in DataFrame operations only.

A document's characters are counted by class and its words by common word. Each histogram is compared
with that of its language by Jensen-Shannon distance. A text of few characters or words has no
reliable histogram, so each distance is only judged from a minimum length on.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import documents
from sparkprep.workspace import settle

# Frequent function words of each language.
COMMON_WORDS = {
    "en": "the and of to in a is that it for was on with as be at by this from are he an or not".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par au pas sur il".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo".split(),
}

# Classes of characters, by the code points they hold.
CHARACTER_CLASSES = {
    "lower": "[a-zß-öø-ÿ]",
    "upper": "[A-ZÀ-ÖØ-Þ]",
    "digit": "[0-9]",
    "space": "[\\x20\\x09-\\x0D]",
    "stop": "[.,;:!?'\"()-]",
    "symbol": "[#*$%&|<>@~^_=+/\\\\{}\\[\\]]",
}

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
ADDED = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "char_distance", "word_distance", "kept",
)


def _members(pattern: str) -> str:
    """The characters of a class, which holds none beyond the first 65536 code points."""
    found = re.compile(pattern)
    return "".join(c for c in map(chr, range(1 << 16)) if not 0xD800 <= ord(c) < 0xE000 and found.fullmatch(c))


SYMBOLS = "[#*$%&|<>]"
"""The symbols that are counted by themselves, all of the class ``symbol``."""


def _marks() -> dict[str, str]:
    """The members of each class, with the counted symbols apart from the other symbols."""
    members = {name: _members(pattern) for name, pattern in CHARACTER_CLASSES.items()}
    counted = _members(SYMBOLS)
    members["symbol"] = "".join(c for c in members["symbol"] if c not in counted)
    return {**members, "counted": counted}


def _classes(text: str = "_text") -> dict[str, Column]:
    """Characters of each class: one translate turns every member into the first of its class, and each
    of those is then counted by a plain replace, without a regular expression."""
    members = _marks()
    marked = F.translate(F.col(text), "".join(members.values()), "".join(m[0] * len(m) for m in members.values()))
    count = lambda m: F.length(marked) - F.length(F.replace(marked, F.lit(m[0]), F.lit("")))
    found = {name: count(m) for name, m in members.items()}
    return {**found, "symbol": found["symbol"] + found["counted"]}


def _windows(words: str = "_words") -> Column:
    """Hashes of the 3-word windows, by place."""
    w = F.col(words)
    n = F.size(w)
    hashed = lambda k: F.xxhash64(F.get(w, k), F.get(w, k + 1), F.get(w, k + 2))
    none = F.array().cast("array<bigint>")
    return F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), hashed)).otherwise(none)


def _repeated_places() -> Column:
    """Places of windows that occur twice or more: equal hashes are neighbours once sorted."""
    numbered = F.transform("_windows", lambda h, k: F.struct(h.alias("h"), k.alias("k")))
    return F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(numbered))


def describe(docs: DataFrame, text: str = "text", carry_text: bool = True) -> DataFrame:
    """``docs`` with the base counts, character classes and occurrences of listed words."""
    kept = [c for c in docs.columns if c.lower() not in ADDED and (carry_text or c != text)]
    held = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    # a split leaves an empty string before leading and after trailing space
    held = held.withColumn("_words", F.array_remove(F.split("_text", SPACES), ""))
    listed = sorted({w for words in COMMON_WORDS.values() for w in words})
    bare = F.split(F.lower("_text"), r"[\x20\x09-\x0D.,;:!?]+")
    held = (
        held.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD)))
        .withColumn("_hits", F.filter(bare, lambda w: w.isin(listed)))
        .withColumn("_windows", _windows())
        .withColumn("_sorted", _repeated_places())
    )
    ordered = F.col("_sorted")
    same = lambda a, b: F.coalesce(F.get(ordered, a)["h"] == F.get(ordered, b)["h"], F.lit(False))
    places = F.filter(ordered, lambda x, k: same(k, k - 1) | same(k, k + 1))
    places = F.sort_array(F.transform(places, lambda x: x["k"]))
    held = held.withColumn("_places", F.coalesce(places, F.array().cast("array<int>")))
    # each repeated window adds the words up to the next one, three at most
    repeated = F.aggregate(
        F.zip_with(
            F.slice("_places", 2, F.greatest(F.size("_places"), F.lit(1))),
            F.slice("_places", 1, F.greatest(F.size("_places") - 1, F.lit(0))),
            lambda b, a: F.least(F.lit(3), b - a),
        ),
        F.lit(0).cast("long"),
        lambda s, x: s + x,
    ) + F.when(F.size("_places") > 0, 3).otherwise(0)
    total = F.length("_text")
    counts = _classes()
    classes = [counts[name].cast("double") for name in CHARACTER_CLASSES]
    held = held.withColumn("_known", F.array(*classes))
    space = list(CHARACTER_CLASSES).index("space")
    known = F.aggregate("_known", F.lit(0.0), lambda s, x: s + x)
    return held.select(
        *(F.col(f"`{c}`") for c in kept),
        F.size("_words").cast("long").alias("n_words"),
        (total - F.get("_known", F.lit(space))).cast("long").alias("word_chars"),
        counts["counted"].cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        F.concat("_known", F.array(F.greatest(total - known, F.lit(0.0)))).alias("_classes"),
        F.col("_hits"),
    )


def common_counts(hits: Column, n_words: Column, words: list[str]) -> Column:
    """How often each of ``words`` occurs, and then all other words."""
    def occurrences(word: str) -> Column:
        return F.size(F.filter(hits, lambda w: w == word)).cast("double")

    counted = F.array(*map(occurrences, words))
    rest = n_words - F.aggregate(counted, F.lit(0.0), lambda s, x: s + x)
    return F.concat(counted, F.array(F.greatest(rest, F.lit(0.0))))


def with_common(described: DataFrame, language: str) -> DataFrame:
    """Adds ``_common``, counts of the language's common words; NULL for a language without a list."""
    chosen = F.lit(None).cast("array<double>")
    for name, words in COMMON_WORDS.items():
        found = common_counts(F.col("_hits"), F.col("n_words"), words)
        chosen = F.when(F.col(language) == name, found).otherwise(chosen)
    return described.withColumn("_common", chosen).drop("_hits")


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms with the same bins."""
    share = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    p_all, q_all = share(counts), share(reference)
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    both = F.zip_with(counts, reference, lambda p, q: F.struct((p / p_all).alias("p"), (q / q_all).alias("q")))
    parts = F.transform(
        both, lambda r: (term(r["p"], (r["p"] + r["q"]) / 2) + term(r["q"], (r["p"] + r["q"]) / 2)) / 2
    )
    summed = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return F.when((p_all > 0) & (q_all > 0), F.sqrt(F.greatest(summed, F.lit(0.0))))


def references(described: DataFrame, language: str) -> DataFrame:
    """Reference histograms of each listed language, over all texts that pass the base rules.

    Each document adds its shares rather than its counts, so long ones don't rule. One row for each
    listed language, at most four.
    """
    good = described.where(~F.col("base_failed") & F.col(language).isin(list(COMMON_WORDS)))
    sums = []
    for column, bins in (("_classes", len(CHARACTER_CLASSES) + 1), ("_common", None)):
        total = F.aggregate(column, F.lit(0.0), lambda s, x: s + x)
        most = bins or 1 + max(map(len, COMMON_WORDS.values()))
        shares = [F.sum(F.get(F.col(column), F.lit(k)) / F.nullif(total, F.lit(0.0))) for k in range(most)]
        sums.append(F.array_compact(F.array(*shares)).alias(f"_ref{column}"))
    return good.groupBy(F.col(language).alias("_language")).agg(*sums)


def judge(
    docs: DataFrame,
    text: str = "text",
    language: str = "lang",
    least_chars: int = 200,
    most_char_distance: float = 0.28,
    least_words: int = 80,
    most_word_distance: float = 0.15,
    word_noise: float = 1.5,
    carry_text: bool = True,
) -> DataFrame:
    """``docs`` with the base counts, the two distances and ``kept``.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated 3-word windows. Other
    texts are kept unless a distance is above its limit; the distance of characters is judged from
    ``least_chars`` characters in words on, that of words from ``least_words`` words on. Counts of few
    words scatter, so the limit for words is ``most_word_distance`` and ``word_noise`` over the
    square root of the number of words. A language
    without a list, or a NULL one, is never judged by distance. NULL and empty texts have no words.
    """
    described = with_common(describe(docs, text, carry_text), language)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    described = settle(described.withColumn("base_failed", failed), "quality-counts")
    fitted = F.broadcast(references(described, language))  # four rows at most
    joined = described.join(fitted, F.col(language) == F.col("_language"), "left")
    joined = joined.withColumn("char_distance", js_distance(F.col("_classes"), F.col("_ref_classes")))
    joined = joined.withColumn("word_distance", js_distance(F.col("_common"), F.col("_ref_common")))
    most_words = F.lit(most_word_distance) + F.lit(word_noise) / F.sqrt("n_words")
    far = lambda c, most, n, least: (F.col(n) >= least) & F.coalesce(F.col(c) > most, F.lit(False))
    kept = (
        ~F.col("base_failed")
        & ~far("char_distance", most_char_distance, "word_chars", least_chars)
        & ~far("word_distance", most_words, "n_words", least_words)
    )
    hidden = ("_classes", "_common", "_language", "_ref_classes", "_ref_common")
    return joined.withColumn("kept", kept).drop(*hidden)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, distances from the language's histograms and the verdict on each document."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text", "lang")
    judged = judge(docs, carry_text=False)
    return judged.select("doc_id", *ADDED)
