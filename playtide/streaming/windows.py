"""Running counts over a stream of plays: top artists, top tracks, plays over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playtide.streaming import stores
from playtide.streaming.ingest import batch_name


def windowed_counts(plays: DataFrame, keys: Sequence[str], played_at: str = "played_at",
                    window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Plays per tumbling window and key; rows later than ``delay`` are dropped.

    Counts are combined in every input partition first, so a track with most of
    the plays adds one row per partition to the shuffle.
    """
    return (plays.withWatermark(played_at, delay)
            .groupBy(F.window(played_at, window).alias("span"), *keys)
            .agg(F.count("*").alias("plays"))
            .select(F.col("span.start").alias("window_start"),
                    F.col("span.end").alias("window_end"), *keys, "plays"))


def keep_counts(counts: DataFrame, keys: Sequence[str], path: str, checkpoint: str,
                once: bool = False) -> StreamingQuery:
    """Write changed counts after every batch; ``read_counts`` gives the newest per window.

    Counts only grow, so the newest one is the largest, also after a replay.
    """
    identity = ["window_start", *keys]

    def write(batch: DataFrame, batch_id: int) -> None:
        stores.upsert_latest(batch, path, identity, ["plays"], batch_name(batch, batch_id))

    writer = (counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
              .foreachBatch(write))
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_counts(spark: SparkSession, path: str, schema: T.StructType,
                keys: Sequence[str]) -> DataFrame:
    return stores.read_latest(spark, path, schema, ["window_start", *keys], ["plays"])


def insert_distinct(plays: DataFrame, keys: Sequence[str], order: Sequence[str], day_of: str, path: str,
                    checkpoint: str, once: bool = False) -> StreamingQuery:
    """Streaming duplicates removed exactly: the first row of each key goes to an insert table."""
    writer = plays.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: stores.insert_if_absent(batch, path, keys, order, batch_name(batch, batch_id), day_of))
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def distinct_plays(plays: DataFrame, keys: Sequence[str], played_at: str = "played_at",
                   delay: str = "1 day") -> DataFrame:
    """Streaming duplicates removed with bounded state: keys are forgotten after ``delay``.

    The insert route is the exact form without a bound.
    """
    return plays.withWatermark(played_at, delay).dropDuplicatesWithinWatermark(list(keys))
