"""Keyed Parquet tables that can be written again and again without doubling rows.

Every write goes to folders ``ingest=<id>`` of its own, which a retry replaces; in insert
tables they lie inside the folders of the days. The id names the streaming query and the
batch, so batches of another checkpoint never overwrite each other. There is one writer
per table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.operators.tables import keep_first


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.exists(jvm_path)


def _folders(spark: SparkSession, path: str, column: str = "ingest") -> list[str]:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [s.getPath().toString() for s in fs.listStatus(jvm_path)
            if s.isDirectory() and s.getPath().getName().startswith(f"{column}=")]


def _delete(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.delete(jvm_path, True)


def _schema(columns: T.StructType, *partitions: str) -> T.StructType:
    return T.StructType([*columns.fields, *[T.StructField(p, T.StringType()) for p in partitions]])


# --- insert if absent -------------------------------------------------------

def insert_if_absent(batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str],
                     ingest: str, day_of: str) -> None:
    """Add rows whose key is not stored yet; within the batch the first by ``order`` counts.

    ``day_of`` is a key column holding an ISO time. Its day partitions the table, so
    equal keys share a day and only the days in the batch are read: the join with them
    prunes the scan when it runs.
    """
    spark = batch.sparkSession
    day = F.coalesce(F.regexp_extract(day_of, r"^\d{4}-\d{2}-\d{2}", 0), F.lit(""))
    batch = batch.withColumn("day", F.when(day == "", F.lit("unknown")).otherwise(day))
    rows = keep_first(batch, keys, order)
    if path_exists(spark, path):
        columns = T.StructType([batch.schema[k] for k in keys])
        stored = (spark.read.schema(_schema(columns, "day", "ingest"))
                  .option("basePath", path).parquet(path).where(F.col("ingest") != ingest))
        known = stored_keys(stored, rows, keys)
        rows = rows.join(known, list(keys), "left_anti")
    # Rebalancing splits a day that holds most of the batch and merges small ones.
    (rows.withColumn("ingest", F.lit(ingest)).hint("rebalance", "day").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day", "ingest").parquet(path))


def stored_keys(stored: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Those keys of a batch that the table has, from the days of the batch alone.

    The days are broadcast so that their list prunes the scan; they are short texts, at
    most one per row of a batch, whose size the stream's rate limit bounds.
    """
    days = F.broadcast(rows.select("day").distinct())
    return stored.join(days, "day", "left_semi").select(*keys).join(rows.select(*keys), list(keys), "left_semi")


def read_inserted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of an insert-if-absent table with the ``day`` they are stored under."""
    return (spark.read.schema(_schema(schema, "day", "ingest")).option("basePath", path)
            .parquet(path).drop("ingest"))


def compact_inserted(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                     order: Sequence[str], before: str) -> None:
    """Bring each day before ``before`` (an ISO date) together in one folder.

    Rebalancing sizes the files. The new folders are complete before the old ones go; after a
    stop in between, running it again removes the copies.
    """
    name = f"compact-{uuid.uuid4().hex}"
    closed = [folder for folder in _folders(spark, path, "day") if folder.rsplit("=", 1)[1] < before]
    old = [folder for day in closed for folder in _folders(spark, day)]
    if len(old) <= len(closed):
        return
    rows = (spark.read.schema(_schema(schema, "day", "ingest")).option("basePath", path)
            .parquet(*closed).drop("ingest"))
    (keep_first(rows, [*keys, "day"], order).withColumn("ingest", F.lit(name)).hint("rebalance", "day")
     .write.mode("append").partitionBy("day", "ingest").parquet(path))
    for folder in old:
        _delete(spark, folder)


# --- keep latest ------------------------------------------------------------

def upsert_latest(batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str],
                  ingest: str) -> None:
    """Add the last arrival per key in the batch; readers resolve arrivals across batches.

    Writing costs as much as the batch. Replays only add copies that lose or tie.
    """
    latest = keep_first(batch, keys, [F.desc_nulls_last(c) for c in order])
    latest.write.mode("overwrite").parquet(f"{path}/ingest={ingest}")


def read_latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                order: Sequence[str]) -> DataFrame:
    """One row per key: the last arrival over all batches."""
    rows = spark.read.schema(_schema(schema, "ingest")).option("basePath", path).parquet(path)
    return keep_first(rows.drop("ingest"), keys, [F.desc_nulls_last(c) for c in order])


def compact_latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                   order: Sequence[str]) -> None:
    """Replace the folders written so far by one with their current rows.

    The new folder is complete before the old ones go; stopping in between leaves
    copies that ``read_latest`` resolves as usual.
    """
    old = _folders(spark, path)
    if len(old) < 2:
        return
    rows = (spark.read.schema(_schema(schema, "ingest")).option("basePath", path)
            .parquet(*old).drop("ingest"))
    latest = keep_first(rows, keys, [F.desc_nulls_last(c) for c in order])
    latest.write.mode("overwrite").parquet(f"{path}/ingest=compact-{uuid.uuid4().hex}")
    for folder in old:
        _delete(spark, folder)


# --- seeds ------------------------------------------------------------------

def seed_if_empty(rows: DataFrame, path: str, key: str | None = None,
                  order: Sequence[str] = ()) -> bool:
    """Write ``rows`` as a table unless it already holds rows; tells whether it wrote.

    With a ``key``, the first row per key by ``order`` is kept; the order must be given.
    """
    if key and not order:
        raise ValueError("a keyed seed needs an order: it decides which row of a key stays")
    spark = rows.sparkSession
    if path_exists(spark, path):
        stored = spark.read.schema(rows.schema).parquet(path)
        if not stored.isEmpty():
            return False
    if key:
        rows = keep_first(rows, [key], list(order))
    rows.write.mode("overwrite").parquet(path)
    return True


def seed_tables(seeds: dict[str, DataFrame], base: str,
                keys: dict[str, tuple[str, Sequence[str]]] | None = None) -> dict[str, bool]:
    """Seed every named table below ``base``; per table whether it was written.

    ``keys`` gives a table's key and the order that decides which row of a key stays.
    """
    keys = keys or {}
    return {name: seed_if_empty(rows, f"{base}/{name}", *keys.get(name, ())) for name, rows in seeds.items()}


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
