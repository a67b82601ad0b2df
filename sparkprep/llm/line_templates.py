"""Line dedup with a tree of log templates, in DataFrame operations only.

A line goes down a tree of fixed depth: by its number of tokens, then by its leading tokens, where a
token with a digit is a wildcard. A leaf can hold several templates. A line's family in its leaf is about
as large as the number of texts that hold most of the line's tokens at their places; tokens that clearly
fewer texts have there are variable fields, and the others are the template. Lines without such a family
are templates of their own. Lines with too few tokens for fields are templates as they are, with their
numbers. A template that recurs across documents is dropped.

Copies of a document share all their lines, and dropping those would empty the copies. So a template
must recur across documents that have something of their own, and not the same: the lines that do not
recur make half of the text, or a quarter of it and ``own_words`` words. Equal remainders count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import documents, dropping, hot_join
from sparkprep.workspace import release, settle

ADDED = ("n_lines", "dropped", "kept_text")
WILDCARD = "<*>"


def _masked(line: Column) -> Column:
    """The line without space around it, tokens with a digit as wildcards."""
    hidden = F.regexp_replace(line, "(?<![^ ])[^ 0-9]*[0-9][^ ]*", WILDCARD)
    return F.trim(F.when(line.rlike("[0-9]"), hidden).otherwise(line))


def _lines(docs: DataFrame, text: str, depth: int, least_tokens: int) -> DataFrame:
    """Lines that are not blank, with their place, their leaf and a hash of the line with wildcards.

    A line of fewer than ``least_tokens`` tokens has no wildcards, and a leaf of its own.
    """
    split = docs.select(
        "_doc", F.xxhash64(F.col(text)).alias("_text"), F.split(F.col(text), "\n").alias("_lines")
    )
    lines = split.select("_doc", "_text", F.posexplode("_lines").alias("place", "line"))
    lines = lines.where(F.col("line").rlike(r"\S")).withColumn("masked", _masked(F.col("line")))
    lines = lines.withColumn("tokens", F.split("masked", " "))
    short = F.size("tokens") < least_tokens
    leaf = F.xxhash64(F.size("tokens"), *(F.get("tokens", F.lit(k)) for k in range(depth)))
    line_hash = F.xxhash64(F.when(short, F.trim("line")).otherwise(F.col("masked")))
    return lines.select(
        "_doc", "_text", "place",
        F.when(short, line_hash).otherwise(leaf).alias("leaf"),
        line_hash.alias("line_hash"),
        F.length("line").alias("chars"),
        F.size("tokens").alias("words"),
    )


def line_templates(
    docs: DataFrame, keys: DataFrame, text: str, depth: int, least_docs: int, agreement: float
) -> DataFrame:
    """For each distinct line: its template, its rows and in how many texts it occurs."""
    by_line = (
        keys.groupBy("leaf", "line_hash", "_text")
        .agg(F.count("*").alias("rows"), F.min(F.struct("_doc", "place")).alias("at"))
        .groupBy("leaf", "line_hash")
        .agg(F.sum("rows").alias("rows"), F.count("*").alias("texts"), F.min(F.struct("at", "_text")).alias("at"))
    )
    by_line = settle(by_line, "line-hashes")
    # Only a leaf with several lines, together in enough texts, has variable fields to find.
    leaves = by_line.groupBy("leaf").agg(F.count("*").alias("n"), F.sum("texts").alias("leaf_texts"))
    mixed = settle(leaves.where((F.col("n") > 1) & (F.col("leaf_texts") >= least_docs)), "line-leaves")
    samples = hot_join(by_line, mixed, ["leaf"], "n")
    # One place of each such line; its tokens are read from the text there.
    wanted = samples.groupBy(
        F.col("at.at._doc").alias("_at_doc"), F.col("at._text").alias("_at_text")
    ).agg(
        F.collect_list(
            F.struct("leaf", "line_hash", "texts", "leaf_texts", F.col("at.at.place").alias("place"))
        ).alias("wanted")
    )
    here = F.col("_doc").eqNullSafe(F.col("_at_doc")) & (F.xxhash64(F.col(text)) == F.col("_at_text"))
    tokens = (
        docs.join(wanted, here)
        .select(F.split(F.col(text), "\n").alias("_lines"), F.explode("wanted").alias("w"))
        .select("w.*", F.split(_masked(F.get("_lines", F.col("w.place"))), " ").alias("tokens"))
        .dropDuplicates(["leaf", "line_hash"])
    )
    # Leading tokens are those of the leaf, so only the places beyond them are looked at.
    cells = settle(
        tokens.select(
            "leaf", "line_hash", "texts", "leaf_texts", F.size("tokens").alias("size"),
            F.posexplode("tokens").alias("k", "token"),
        )
        .where(F.col("k") >= depth)
        .select("leaf", "line_hash", "texts", "leaf_texts", "size", "k", F.xxhash64("token").alias("token")),
        "line-cells",
    )
    common = (
        cells.groupBy("leaf", "k", "token")
        .agg(F.sum("texts").alias("held"), F.count("*").alias("rows"))
        .where(F.col("held") >= least_docs)
    )
    common = settle(common, "line-common")
    # A line's common tokens, with the number of texts that have them at the same place.
    line = hot_join(cells, common, ["leaf", "k", "token"], "rows").groupBy("leaf", "line_hash").agg(
        F.first("size").alias("size"),
        F.first("leaf_texts").alias("leaf_texts"),
        F.sort_array(F.collect_list(F.struct("k", "token", "held"))).alias("common"),
    )
    held = F.sort_array(F.transform("common", lambda c: c["held"]), asc=False)
    family = F.get(held, F.ceil(agreement * (F.col("size") - depth)).cast("int") - 1)
    whole = F.size(F.filter("common", lambda c: c["held"] >= agreement * F.col("leaf_texts")))
    whole = whole + depth >= agreement * F.col("size")
    line = line.withColumn("family", F.when(whole, F.col("leaf_texts")).otherwise(family))
    fixed = F.filter("common", lambda c: c["held"] >= agreement * F.col("family"))
    shared = line.where("family IS NOT NULL").select(
        "leaf", "line_hash",
        F.xxhash64("leaf", F.lit(WILDCARD), F.transform(fixed, lambda c: F.struct(c["k"], c["token"]))).alias("shared"),
    )
    found = by_line.join(shared, ["leaf", "line_hash"], "left").select(
        "leaf", "line_hash", "rows", F.coalesce("shared", "line_hash").alias("template")
    )
    found = settle(found, "line-templates")
    release(by_line, mixed, cells, common)
    return found


def drop_recurring_lines(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    depth: int = 3,
    least_docs: int = 3,
    least_tokens: int = 4,
    agreement: float = 0.7,
    own_words: int = 30,
) -> DataFrame:
    """``docs`` with ``n_lines``, ``dropped`` (places of dropped lines, from 0) and ``kept_text``.

    A template is dropped if ``least_docs`` documents hold it whose lines that do not recur differ, and
    make half of the text, or a quarter and ``own_words`` words. Lines of fewer than ``least_tokens``
    tokens must recur as they are; blank lines are left alone. A NULL text has no lines and stays NULL; a
    text whose lines all go is empty. Rows with equal ``key`` and text are treated alike, whatever the key.
    """
    docs = dropping(docs, *ADDED)
    held = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_doc"), F.col(text))
    keys = settle(_lines(held, text, depth, least_tokens), "line-keys")
    templates = line_templates(held, keys, text, depth, least_docs, agreement)
    placed = settle(hot_join(keys, templates, ["leaf", "line_hash"], "rows"), "line-places")
    release(keys, templates)

    # In how many texts each template is, and what of each text is in lines that do not recur.
    pairs = placed.groupBy("template", "_text").agg(
        F.count("*").alias("n"),
        F.sum("chars").alias("chars"),
        F.sum("words").alias("words"),
        F.sum(F.shiftrightunsigned("line_hash", 32)).alias("mark"),
    )
    pairs = settle(pairs, "line-pairs")
    spread = pairs.groupBy("template").agg(F.count("*").alias("texts"), F.sum("n").alias("rows"))
    recurring = settle(spread.where(F.col("texts") >= least_docs), "line-recurring")
    recurs = recurring.select("template", F.col("texts").alias("rows"), F.lit(True).alias("recurs"))
    marked = settle(hot_join(pairs, recurs, ["template"], "rows", "left"), "line-marked")
    release(pairs)
    own = F.col("recurs").isNull()
    texts = marked.groupBy("_text").agg(
        F.sum("chars").alias("chars"),
        F.sum(F.when(own, F.col("chars"))).alias("own_chars"),
        F.sum(F.when(own, F.col("words"))).alias("own_words"),
        F.sum(F.when(own, F.col("mark"))).alias("mark"),
        F.bool_or("recurs").alias("recurs"),
    )
    # Sums are over all rows with that text.
    rows = held.groupBy(F.xxhash64(F.col(text)).alias("_text")).agg(F.count("*").alias("copies"))
    much = (4 * F.col("own_chars") >= F.col("chars")) & (F.col("own_words") >= own_words * F.col("copies"))
    texts = texts.where("recurs").join(rows, "_text").where((2 * F.col("own_chars") >= F.col("chars")) | much)
    texts = texts.select("_text", (F.col("mark") / F.col("copies")).alias("remainder"))
    boilerplate = (
        marked.where("recurs")
        .join(texts, "_text")
        .select("template", "remainder")
        .distinct()
        .groupBy("template")
        .agg(F.count("*").alias("remainders"))
        .where(F.col("remainders") >= least_docs)
    )
    boilerplate = settle(boilerplate.join(recurring.select("template", "rows"), "template"), "line-boilerplate")
    gone = hot_join(placed, boilerplate, ["template"], "rows")
    gone = gone.groupBy("_doc", "_text").agg(F.sort_array(F.collect_set("place")).alias("dropped"))
    gone = settle(gone, "line-gone")
    release(placed, marked, recurring, boilerplate)

    given = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(key).alias("_key"),
        F.xxhash64(F.col(text)).alias("_hash"),
    )
    joined = given.join(gone, F.col("_key").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_text")), "left")
    lines = F.split(F.col("row")[text], "\n")
    return joined.select(
        "row.*",
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.col("dropped"), F.array().cast("array<int>")).alias("dropped"),
        F.when(F.col("dropped").isNull(), F.col("row")[text]).otherwise(_without(lines, F.col("dropped"))).alias("kept_text"),
    )


def _without(lines: Column, dropped: Column) -> Column:
    """The text of ``lines`` without the dropped places, in one sort: a line goes if its place is before it."""
    kept = F.transform(lines, lambda x, k: F.struct(k.alias("k"), F.lit(1).alias("kind"), x.alias("x")))
    marks = F.transform(dropped, lambda k: F.struct(k.alias("k"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("x")))
    both = F.sort_array(F.concat(kept, marks))
    before = F.slice(F.concat(F.array(F.lit(-1)), F.transform(both, lambda e: F.when(e["kind"] == 0, e["k"]).otherwise(-1))), F.lit(1), F.size(both))
    stays = F.zip_with(both, before, lambda e, k: F.when(e["k"] != k, e["x"]))
    return F.array_join(stays, "\n")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that belong to recurring templates, and the text without them."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")
    found = drop_recurring_lines(docs)
    return found.select(
        "doc_id",
        F.col("n_lines").cast("long"),
        F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join("dropped", ",").alias("dropped_lines"),
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )
