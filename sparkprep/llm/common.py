"""What the text operators share: column handling, Arrow batches and joins on skewed keys."""

from __future__ import annotations

import io
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from sparkprep.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

HOT_ROWS = 20_000
"""Rows of one key that a join leaves together in any case."""

MOST_HOT = 10_000
"""No more keys than this are ever broadcast as hot ones."""


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return table(spark, sf_dir, name)


_shipped: set[str] = set()


BATCH_ROWS = "2000"
"""Rows of an Arrow batch: texts are long, so Spark's 10,000 rows would take much memory."""


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so that tasks find its functions wherever they run.

    Spark's file server hands out the archive; no executor needs to see the driver's folder. The size
    of Arrow batches is lowered too, unless the session has set its own.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, BATCH_ROWS)
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    folder = tempfile.mkdtemp(prefix="sparkprep-code-")
    path = Path(folder) / f"{package.name}.zip"
    path.write_bytes(content.getvalue())
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(application)


def dropping(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken))


def pieces(
    batches: Iterable[pa.RecordBatch], column: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one holds at most ``most_bytes`` of text, or a single row."""
    for batch in batches:
        sizes = batch.column(column).cast(pa.large_binary())
        offsets = sizes.buffers()[1]
        if batch.num_rows == 0 or offsets is None:
            continue
        ends = memoryview(offsets).cast("q")[sizes.offset : sizes.offset + batch.num_rows + 1]
        start = 0
        for row in range(1, batch.num_rows + 1):
            if row == batch.num_rows or ends[row + 1] - ends[start] > most_bytes:
                yield batch.slice(start, row - start)
                start = row


MOST_HOT_BYTES = 64 << 20
"""No more bytes than this are ever broadcast with hot keys."""


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row has."""
    sizes = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType | BinaryType):
            sizes.append(F.octet_length(value))
        elif isinstance(field.dataType, ArrayType | MapType | StructType):
            sizes.append(F.octet_length(F.to_json(F.struct(value))))
        else:
            sizes.append(F.lit(8))
    return reduce(Column.__add__, (F.coalesce(s, F.lit(0)).cast("long") for s in sizes))


def hot_join(
    many: DataFrame,
    one: DataFrame,
    keys: list[str],
    rows: str,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    most_bytes: int = MOST_HOT_BYTES,
) -> DataFrame:
    """Join ``many`` to ``one``, which has one row for each key, without a hot task.

    ``rows`` is a column of ``one``: how many rows of ``many`` the key has, nearly. Keys with at least
    ``hot_rows`` rows and a ``1 / MOST_HOT`` share of all rows are hot. There are at most ``MOST_HOT``
    of them, whatever the input. If what ``one`` has for them is at most ``most_bytes``, it is
    broadcast; if it is more, only keys are, which are taken to be short, and hot rows are shuffled in parts:
    each row of ``one`` is copied for each part of about as many rows as make a key hot. Other rows are
    shuffled by key. ``many`` is read twice if there are hot keys, so it should be a table.
    """
    total, most = one.agg(F.sum(rows), F.max(rows)).first()
    limit = max(hot_rows, (total or 0) // MOST_HOT)
    if (most or 0) < limit:
        return many.join(one, keys, how).drop(rows)
    hot = one.where(F.col(rows) >= limit)
    rest = many.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    cold = rest.join(one.where(F.col(rows) < limit), keys, how)
    if hot.agg(F.sum(_row_bytes(hot))).first()[0] <= most_bytes:
        apart = many.join(F.broadcast(hot), keys)
    else:
        parts = F.ceil(F.col(rows) / limit).cast("int")
        counts = F.broadcast(hot.select(*keys, parts.alias("_parts")))
        dealt = many.join(counts, keys).withColumn(
            "_part", F.pmod(F.monotonically_increasing_id(), F.col("_parts")).cast("int")
        )
        copied = hot.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        apart = dealt.drop("_parts").join(copied, [*keys, "_part"]).drop("_part")
    return apart.unionByName(cold).drop(rows)
