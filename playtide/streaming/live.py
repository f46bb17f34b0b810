"""Keyed tables with a list of live folders, merged in size tiers.

A table is a folder with ``data/part=<name>/bucket=<n>/`` and ``live/<version>.json``. The newest
version lists the folders that make up the table, each with its tier; a reader takes that list and
nothing else. Writing or merging first completes new folders and then adds a version in one
step, a rename, so readers see the table before or after and never rows twice. Folders that
left the list stay for ``GRACE`` versions, for readers that have begun.

Rows are dealt to buckets by a hash of their key. A batch looks for its keys in the buckets it
touches: their numbers prune the scan's folders, and the keys of a batch are broadcast up to
``SMALL_BATCH`` of them, which a stream's rate keeps to, so the stored side isn't shuffled. ``FAN`` folders of a tier are merged
into one of the next tier: a row is rewritten once per tier, and readers meet less than ``FAN``
folders per tier, whatever the number of batches.

A version also names the last batch of each writer, so a batch that comes again is known
and left alone. There is one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.operators.tables import keep_first

FAN = 4
GRACE = 6
SMALL_BATCH = 500_000  # keys of a batch that are broadcast


@dataclass(frozen=True)
class Version:
    number: int = 0
    folders: dict[str, int] = field(default_factory=dict)  # name and tier
    retired: dict[str, int] = field(default_factory=dict)  # name and the version that dropped it
    done: dict[str, int] = field(default_factory=dict)  # writer and its last batch


@dataclass(frozen=True)
class LiveTable:
    """``keep`` says which row of a key stays: the ``first`` that was stored, or the ``last`` by ``order``."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]
    keep: str = "first"
    buckets: int = 16

    def __post_init__(self) -> None:
        if self.keep not in ("first", "last"):
            raise ValueError(f"unknown rule {self.keep!r}")

    # --- reading

    def version(self, spark: SparkSession) -> Version:
        fs, folder = _file_system(spark, f"{self.path}/live")
        if not fs.exists(folder):
            return Version()
        names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json"))
        if not names:
            return Version()
        text = spark.read.option("wholetext", True).text(f"{self.path}/live/{names[-1]}").first()[0]
        return Version(**json.loads(text))

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per key."""
        version = self.version(spark)
        rows = self._folders(spark, version.folders).drop("bucket", "part")
        return self._one_per_key(rows) if self.keep == "last" and len(version.folders) > 1 else rows

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the given keys, from the buckets that hold them alone."""
        spark = keys.sparkSession
        wanted = self._bucketed(keys.select(*self.keys).distinct())
        rows = self._matched(self._folders(spark, self.version(spark).folders), wanted)
        return self._one_per_key(rows) if self.keep == "last" else rows

    def _folders(self, spark: SparkSession, folders: Sequence[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("part", T.StringType()),
                               T.StructField("bucket", T.IntegerType())])
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/data/part={name}" for name in folders])

    def _matched(self, stored: DataFrame, wanted: DataFrame) -> DataFrame:
        touched = [r.bucket for r in wanted.select("bucket").distinct().collect()]  # at most the number of buckets
        few = wanted.limit(SMALL_BATCH + 1).count() <= SMALL_BATCH
        keys = wanted.select(*self.keys)
        return (stored.where(F.col("bucket").isin(touched)).drop("bucket", "part")
                .join(F.broadcast(keys) if few else keys, list(self.keys), "left_semi"))

    def _one_per_key(self, rows: DataFrame) -> DataFrame:
        order: list[Column] = [F.desc_nulls_last(c) for c in self.order] if self.keep == "last" else \
            [F.asc_nulls_last(c) for c in self.order]
        return keep_first(rows, list(self.keys), order)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    # --- writing

    def write(self, batch: DataFrame, writer: str, number: int) -> bool:
        """Store a batch once; tells whether it was new. Merges what its tier has too many of."""
        spark = batch.sparkSession
        version = self.version(spark)
        if version.done.get(writer, -1) >= number:
            return False
        rows = self._one_per_key(batch.select(*[f.name for f in self.schema]))
        if self.keep == "first" and version.folders:
            known = self._matched(self._folders(spark, version.folders), self._bucketed(rows)).select(*self.keys)
            rows = rows.join(known, list(self.keys), "left_anti")
        name = self._write_folder(rows)
        version = self._publish(spark, version, [name], [], 0, {**version.done, writer: number})
        while full := [tier for tier in set(version.folders.values()) if list(version.folders.values()).count(tier) >= FAN]:
            version = self._merge(spark, version, min(full))
        return True

    def compact(self, spark: SparkSession) -> None:
        """Merge all folders into one."""
        version = self.version(spark)
        if len(version.folders) > 1:
            self._merge(spark, version, None)

    def _merge(self, spark: SparkSession, version: Version, tier: int | None) -> Version:
        old = [name for name, t in version.folders.items() if tier is None or t == tier]
        rows = self._folders(spark, old).drop("part", "bucket")
        name = self._write_folder(self._one_per_key(rows) if self.keep == "last" else rows)
        above = 1 + max(version.folders[n] for n in old)
        return self._publish(spark, version, [name], old, above, version.done)

    def _write_folder(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        # Rebalancing splits a bucket that holds most rows and merges small ones.
        self._bucketed(rows).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/part={name}")
        return name

    def _publish(self, spark: SparkSession, old: Version, added: Sequence[str], dropped: Sequence[str], tier: int,
                 done: dict[str, int]) -> Version:
        number = old.number + 1
        folders = {n: t for n, t in old.folders.items() if n not in dropped} | {n: tier for n in added}
        gone = [n for n, since in old.retired.items() if since + GRACE <= number]
        retired = {n: s for n, s in old.retired.items() if n not in gone} | {n: number for n in dropped}
        version = Version(number, folders, retired, done)
        fs, folder = _file_system(spark, f"{self.path}/live")
        fs.mkdirs(folder)
        target = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:020d}.json")
        draft = spark._jvm.org.apache.hadoop.fs.Path(folder, f"draft-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(vars(version)).encode()))
        out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            raise RuntimeError(f"another writer has added version {number} of {self.path}")
        for name in gone:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/part={name}"), True)
        previous = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number - GRACE:020d}.json")
        if fs.exists(previous):
            fs.delete(previous, False)
        return version


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm_path
