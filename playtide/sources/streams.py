"""Message streams with the columns ``topic, partition, offset, timestamp, value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtide.schemas import MESSAGE


def broker_stream(spark: SparkSession, servers: str, topics: list[str],
                  max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Topics of a message broker, from their beginning on a new checkpoint."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(topics))
              .option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(
        "topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                file_format: str = "json") -> DataFrame:
    """The same columns out of a folder of message files, oldest file first.

    Files are taken by their modification time; those of the same millisecond may
    arrive in any order, so a collector should write one file per step.
    """
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(file_format).load(path)
