"""The keys of a store, clustered by key, so that a load looks them up without shuffling them.

The index is a table of stored keys in hash buckets. A batch is dealt out by the same hash and meets its
buckets in place; a small batch reads only the buckets that its keys fall into. Each load adds one file
to a bucket at most, and the table is written anew, in more buckets if need be, when files get many.

A folder holds versions of the table and ``current``, a row for each version with its number of
buckets. ``unfinished`` is there while a load writes the store and the index; a load that finds it
knows that one may have keys the other lacks, and fits the index to the store again.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions import column
from sparkprep.workspace import discard, exists, list_files

BUCKET_KEYS = 5_000_000
"""Keys of one bucket when the table is written anew."""

MOST_FILES = 16
"""Files of one bucket on average before the table is written anew."""

FEW_KEYS = 1_000
"""A batch of no more keys is looked up in the buckets of just these keys."""

_VERSIONS = "version int, buckets int, folder string"


class KeyIndex:
    """The keys of the store at ``path``; ``field`` is the key's name and type.

    The table is known to the session's catalog under a name made from its folder. Keys are compared
    as equality does, so NULL is never found.
    """

    def __init__(
        self, spark: SparkSession, path: str, field: T.StructField, bucket_keys: int = BUCKET_KEYS
    ):
        self.spark, self.path, self.field, self.bucket_keys = spark, path, field, bucket_keys

    @property
    def _marker(self) -> str:
        return f"{self.path}/unfinished"

    def _version(self):
        if not exists(self.spark, f"{self.path}/current"):
            return None
        versions = self.spark.read.schema(_VERSIONS).parquet(f"{self.path}/current")
        return versions.orderBy(F.desc("version")).first()

    def _name(self, folder: str) -> str:
        return f"sparkprep_keys_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"

    def _register(self, folder: str, buckets: int) -> str:
        name, key = self._name(folder), f"`{self.field.name}`"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({key} {self.field.dataType.simpleString()}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
        return name

    def _fill(self, keys: DataFrame, name: str, buckets: int) -> None:
        dealt = keys.select(column(self.field.name)).repartition(buckets, column(self.field.name))
        dealt.write.mode("append").insertInto(name)

    def keys(self) -> DataFrame:
        """The table of keys, in buckets."""
        version = self._version()
        return self.spark.table(self._register(version["folder"], version["buckets"]))

    def is_sound(self) -> bool:
        return self._version() is not None and not exists(self.spark, self._marker)

    def write_anew(self, keys: DataFrame) -> None:
        """Replace the table by these keys, each once."""
        old = self._version()
        keys = keys.select(column(self.field.name)).where(column(self.field.name).isNotNull()).distinct()
        buckets = 8
        wanted = keys.count() / self.bucket_keys
        while buckets < wanted:
            buckets *= 2
        folder = f"{self.path}/keys-{uuid.uuid4().hex}"
        self._fill(keys, self._register(folder, buckets), buckets)
        row = (old["version"] + 1 if old else 0, buckets, folder)
        made = self.spark.createDataFrame([row], _VERSIONS)
        made.coalesce(1).write.mode("append").parquet(f"{self.path}/current")
        if old:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(old['folder'])}")
            discard(self.spark, old["folder"])

    def begin(self) -> None:
        """Note that store and index are about to change."""
        self.spark.createDataFrame([(1,)], "begun int").coalesce(1).write.mode("overwrite").parquet(self._marker)

    def add(self, keys: DataFrame) -> None:
        """Add keys that the table lacks, now that the store has them."""
        version = self._version()
        name = self._register(version["folder"], version["buckets"])
        self._fill(keys, name, version["buckets"])
        discard(self.spark, self._marker)
        if len(list_files(self.spark, version["folder"])) > MOST_FILES * version["buckets"]:
            self.write_anew(self.keys())

    def known(self, batch: DataFrame, few_keys: int = FEW_KEYS) -> DataFrame:
        """Stored keys, with at least all those that ``batch`` has too."""
        name = self.field.name
        some = batch.select(column(name)).where(column(name).isNotNull()).limit(few_keys + 1).collect()
        stored = self.keys()
        if len(some) > few_keys:
            return stored
        return stored.where(self._one_of([r[0] for r in some]))

    def _one_of(self, values: list) -> Column:
        return column(self.field.name).isin(values) if values else F.lit(False)

    def unseen(self, batch: DataFrame, few_keys: int = FEW_KEYS) -> DataFrame:
        """Rows of ``batch``, a settled table, whose key is not stored."""
        return batch.join(self.known(batch, few_keys), self.field.name, "left_anti")
