"""Category counts and what follows from them: modes, frequencies and index positions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions import column
from sparkprep.workspace import settle

# A category table is broadcast whole up to these sizes. Beyond them only its hot categories are.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def category_text(df: DataFrame, name: str) -> Column:
    """A column's values as text: JSON for nested types, a cast for the others."""
    nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(column(name)) if nested else column(name).cast("string")


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, category, n)`` for all the columns in one scan; NULL is a category of its own.

    Counts are combined map-side, so a category that fills a third of the table still reaches its
    reducer as one row per task.
    """
    texts = df.select(*(category_text(df, c).alias(c) for c in columns))
    return (
        texts.unpivot([], [column(c) for c in columns], "column", "category")
        .groupBy("column", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_frequent(counts: DataFrame) -> DataFrame:
    """``(column, category, n)`` of each column's most frequent value; ties go to the lowest value.

    A minimum over counted categories keeps one struct per column in memory, where ``mode`` would
    keep every distinct value in one buffer.
    """
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("category")))
    return (
        counts.where(F.col("category").isNotNull())
        .groupBy("column")
        .agg(best.alias("best"))
        .select("column", F.col("best.category").alias("category"), (-F.col("best.minus_n")).alias("n"))
    )


def modes(counts: DataFrame) -> dict[str, str]:
    """:func:`most_frequent` on the driver: one value per column."""
    return {r["column"]: r["category"] for r in most_frequent(counts).collect()}


def impute_modes(df: DataFrame, values: dict[str, str], outputs: dict[str, str]) -> DataFrame:
    """Copy each column of ``outputs`` to its output name with NULL replaced by its mode.

    ``values`` must name a value for every column; add one for a column that has none of its own.
    """
    require_modes(values, list(outputs))
    filled = {out: F.coalesce(column(c), F.lit(values[c])) for c, out in outputs.items()}
    return df.withColumns(filled)


def require_modes(values: dict[str, str], columns: Sequence[str]) -> None:
    empty = [c for c in columns if c not in values]
    if empty:
        raise ValueError(f"no value to impute from in {empty}")


def fold_missing(counts: DataFrame, values: dict[str, str]) -> DataFrame:
    """Counts as they stand after mode imputation: the NULL count goes to the mode.

    Saves counting the imputed table again.
    """
    fill = F.lit(None).cast("string")
    for name, value in values.items():
        fill = F.when(F.col("column") == name, F.lit(value)).otherwise(fill)
    return (
        counts.select("column", F.coalesce("category", fill).alias("category"), "n")
        .groupBy("column", "category")
        .agg(F.sum("n").alias("n"))
    )


def positions(df: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows of each group from 0, in ``order``, without gathering a group in one task.

    The table is range-sorted and written with the number of the slice each row fell into. A row's
    position is its rank within the slice plus the sizes of the slices before it.
    """
    placed = settle(
        df.orderBy(column(group), *order).withColumn("_slice", F.spark_partition_id()), name
    )
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per group and slice: at most one per shuffle partition, plus one per group.
    offsets = (
        placed.groupBy(group, "_slice")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .drop("_size")
    )
    within = Window.partitionBy(group, "_slice").orderBy(*order)
    return (
        placed.withColumn("_rank", F.row_number().over(within))
        .join(offsets, [group, "_slice"])
        .withColumn(name, (F.col("_rank") + F.col("_offset") - 1).cast("long"))
        .drop("_slice", "_rank", "_offset")
    )


def index_labels(counts: DataFrame, small: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``(column, category, n, position)``: categories by count descending, then by value, from 0.

    NULL takes no position. ``counts`` is read twice and should be a settled table. Up to ``small``
    rows a window per column numbers them; beyond that :func:`positions` does.
    """
    known = counts.where(F.col("category").isNotNull())
    order = [F.desc("n"), F.asc("category")]
    if known.limit(small + 1).count() > small:
        return positions(known, "column", order, "position")
    window = Window.partitionBy("column").orderBy(*order)
    return known.withColumn("position", (F.row_number().over(window) - 1).cast("long"))


def _size(table: DataFrame, *by: str) -> list[Row]:
    """Rows, counted rows, and total and longest category bytes of a category table."""
    length = F.octet_length("category")
    zero = F.lit(0)
    return (
        table.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum("n"), zero).alias("total"),
            F.coalesce(F.sum(length), zero).alias("bytes"),
            F.coalesce(F.max(length), zero).alias("longest"),
        )
        .collect()
    )


def attach(
    df: DataFrame,
    key: str,
    table: DataFrame,
    values: dict[str, str],
    *,
    how: str = "left",
    size: Row | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Look ``df[key]`` up in ``table`` and add ``values`` (table column to new name).

    ``table`` is a settled table with distinct ``category`` values, NULL included, and the count
    ``n`` of each. Its size is read first, unless given. A table within both bounds is broadcast. Of a larger one
    only NULL and the hot categories are, those with more than ``1/max_hot`` of the counted rows, of
    which there are fewer than ``max_hot``. Rows that these answer, and rows without a category, stay
    where they are; only the others go through a shuffle join, where no fitted key is hot. ``df`` is
    written once for that, since both parts read it.
    ``how="left"`` keeps every row, ``"inner"`` only those found; ``inner`` never matches NULL,
    as an equality join would not.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    if how == "inner":
        table = table.where(F.col("category").isNotNull())
    text = category_text(df, key)
    size = size or _size(table)[0]
    picked = table.select(
        F.col("category").alias("_category"),
        F.col("n").alias("_n"),
        *(F.col(c).alias(out) for c, out in values.items()),
    )
    if size["rows"] <= max_rows and size["bytes"] <= max_bytes:
        small = F.broadcast(picked.drop("_n"))
        return df.join(small, text.eqNullSafe(F.col("_category")), how).drop("_category")

    max_hot = max(1, min(max_rows, max_bytes // max(1, size["longest"])))
    hot_floor = size["total"] / max_hot
    broadcast = (F.col("_n") > hot_floor) | F.col("_category").isNull()
    hot = picked.where(broadcast).select(
        F.col("_category").alias("_hot_category"),
        F.lit(True).alias("_is_hot"),
        *(F.col(out).alias(f"_hot_{out}") for out in values.values()),
    )
    tail = picked.where(~broadcast).select("_category", *values.values())
    marked = df.withColumn("_text", text)
    marked = marked.join(F.broadcast(hot), F.col("_text").eqNullSafe(F.col("_hot_category")), "left")
    marked = settle(marked, "marked")
    kept = [column(c) for c in df.columns]
    is_apart = F.col("_text").isNull() | F.coalesce(F.col("_is_hot"), F.lit(False))
    apart = marked.where(is_apart if how == "left" else F.col("_is_hot")).select(
        *kept, *(F.col(f"_hot_{out}").alias(out) for out in values.values())
    )
    rest = marked.where(~is_apart).select(*kept, "_text")
    found = rest.join(tail, F.col("_text") == F.col("_category"), how)
    return found.select(*kept, *values.values()).unionAll(apart)


def _attach_large(
    df: DataFrame,
    tables: DataFrame,
    value: str,
    outputs: dict[str, str],
    sizes: dict[str, Row],
    how: str,
    max_rows: int,
    max_bytes: int,
) -> DataFrame:
    """Look several columns up whose tables are too large to broadcast, with one write for all of them.

    The hot categories of all the columns share the bounds and are broadcast together. Rows that these
    answer, or that have no category, in every column stay where they are. Each of the others goes
    through one shuffle join a column; where a column of it is answered already, its part of the join key
    is a salt, so those rows are spread.
    """
    marked, parts = df, {}
    for i, name in enumerate(outputs):
        part = tables.where(F.col("column") == name)
        if how == "inner":
            part = part.where(F.col("category").isNotNull())
        room = min(max_rows, max_bytes // max(1, sizes[name]["longest"])) // len(outputs)
        is_hot = (F.col("n") > sizes[name]["total"] / max(1, room)) | F.col("category").isNull()
        parts[i] = part.where(~is_hot).select(
            F.col("category").alias(f"_category_{i}"), F.col(value).alias(f"_cold_{i}"), F.lit(0).alias(f"_zero_{i}")
        )
        hot = part.where(is_hot).select(
            F.col("category").alias("_hot_category"), F.lit(True).alias(f"_is_hot_{i}"), F.col(value).alias(f"_hot_{i}")
        )
        marked = marked.withColumn(f"_text_{i}", category_text(df, name))
        same = F.col(f"_text_{i}").eqNullSafe(F.col("_hot_category"))
        marked = marked.join(F.broadcast(hot), same, "left").drop("_hot_category")
    marked = settle(marked, "marked")

    texts = [F.col(f"_text_{i}") for i in parts]
    hit = {i: F.coalesce(F.col(f"_is_hot_{i}"), F.lit(False)) for i in parts}
    answered = {i: texts[i].isNull() | hit[i] for i in parts}
    apart = reduce(and_, answered.values())
    stays, rest = marked.where(apart), marked.where(~apart)
    salt = F.pmod(F.xxhash64(*texts), F.lit(1 << 20)).cast("int") + 1
    values = {}
    for i, cold in parts.items():
        key, spread = F.when(~answered[i], texts[i]), F.when(answered[i], salt).otherwise(0)
        rest = rest.join(cold, (key == F.col(f"_category_{i}")) & (spread == F.col(f"_zero_{i}")), "left")
        if how == "inner":
            stays, rest = stays.where(hit[i]), rest.where(hit[i] | F.col(f"_category_{i}").isNotNull())
        values[i] = F.when(answered[i], F.col(f"_hot_{i}")).otherwise(F.col(f"_cold_{i}"))
    kept = [column(c) for c in df.columns]
    found = rest.select(*kept, *(v.alias(out) for v, out in zip(values.values(), outputs.values())))
    hots = (F.col(f"_hot_{i}").alias(out) for i, out in enumerate(outputs.values()))
    return found.unionAll(stays.select(*kept, *hots))


def _attach_each(
    df: DataFrame,
    tables: DataFrame,
    value: str,
    outputs: dict[str, str],
    *,
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Look each column up in its own part of a table with a row per column and category.

    Tables within the bounds are broadcast; the others go through :func:`_attach_large` together.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    sizes, names = {row["column"]: row for row in _size(tables, "column")}, df.columns
    large = {}
    for name, out in outputs.items():
        size = sizes.get(name)
        if size and (size["rows"] > max_rows or size["bytes"] > max_bytes):
            large[name] = out
            continue
        part = tables.where(F.col("column") == name).drop("column")
        df = attach(df, name, part, {value: out}, how=how, size=size, max_rows=max_rows, max_bytes=max_bytes)
    if large:
        df = _attach_large(df, tables, value, large, sizes, how, max_rows, max_bytes)
    return df.select(*(column(c) for c in (*names, *outputs.values())))


def encode_frequency(
    df: DataFrame, counts: DataFrame, outputs: dict[str, str], *, how: str = "left", **bounds
) -> DataFrame:
    """Add each category's fitted count under the output name.

    With ``left`` a category that was not fitted counts 0; ``inner`` drops such rows and NULLs.
    """
    found = _attach_each(df, counts, "n", outputs, how=how, **bounds)
    zero = F.lit(0).cast("long")
    return found.withColumns({out: F.coalesce(column(out), zero) for out in outputs.values()})


def encode_index(
    df: DataFrame, labels: DataFrame, outputs: dict[str, str], **bounds
) -> DataFrame:
    """Add each category's index position; NULL where the category is NULL or was not fitted."""
    return _attach_each(df, labels, "position", outputs, **bounds)


def histogram(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(column(name)).agg(F.count(F.lit(1)).alias("n"))
