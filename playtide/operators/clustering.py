"""Plays laid out so that one user's timeline, or a span of time, reads few files.

Rows are dealt to files by a key that interleaves the bits of a user's bucket with those of the time, so
a file holds some buckets over some span, and a filter on either leaves out most files. Each file is
sorted for timelines and has bloom filters of its users. A zone table beside the files says of each
which buckets and times it holds; readers choose files by it.

Defined results: plays without a time go with the earliest; a null user is a user like any other. Writing
again to the same folder adds files.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 10  # of a user's bucket and of the time


def user_bucket(user: Column) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(1 << BITS)).cast("int")


def interleaved(a: Column, b: Column) -> Column:
    """The bits of two whole numbers below ``2 ** BITS`` in turn, those of ``a`` first."""
    key = F.lit(0).cast("bigint")
    for bit in range(BITS):
        for number, place in ((a, 2 * bit + 1), (b, 2 * bit)):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(number.cast("bigint"), bit).bitwiseAND(F.lit(1)), place))
    return key


def write_clustered(plays: DataFrame, path: str, files: int, user: str = "user_id", played_at: str = "played_at") -> None:
    """Write plays in about ``files`` files below ``path``, and what each of them holds."""
    spark = plays.sparkSession
    seconds = F.unix_seconds(F.col(played_at).cast("timestamp"))
    first, last = plays.agg(F.min(seconds), F.max(seconds)).first()
    span = max(1, (last or 0) - (first or 0))
    place = F.least(F.floor((F.coalesce(seconds, F.lit(first or 0)) - (first or 0)) * (1 << BITS) / span), F.lit((1 << BITS) - 1))
    rows = plays.withColumn("user_bucket", user_bucket(F.col(user)))
    # A user with many plays in one step of time still is spread: the time itself is part of the key.
    (rows.withColumn("_zone", interleaved(F.col("user_bucket"), place))
     .repartitionByRange(files, "_zone", user, played_at)
     .sortWithinPartitions("user_bucket", user, F.desc_nulls_last(played_at)).drop("_zone")
     .write.mode("append").option(f"parquet.bloom.filter.enabled#{user}", "true").parquet(f"{path}/plays"))
    zones = (spark.read.parquet(f"{path}/plays").groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("user_bucket").alias("low"), F.max("user_bucket").alias("high"), F.count("*").alias("plays"),
        F.min(played_at).alias("first"), F.max(played_at).alias("last"), F.count_if(F.col(played_at).isNull()).alias("untimed")))
    zones.write.mode("overwrite").parquet(f"{path}/zones")


def files_of(spark: SparkSession, path: str, user: Column | None = None, since: datetime | None = None,
             until: datetime | None = None) -> list[str]:
    """The files that may hold plays of a user, or of a span of time; one row per file is read for that."""
    zones = spark.read.parquet(f"{path}/zones")
    if user is not None:
        bucket = user_bucket(user)
        zones = zones.where((F.col("low") <= bucket) & (F.col("high") >= bucket))
    if since is not None:
        zones = zones.where(F.col("last") >= F.lit(since))
    if until is not None:
        zones = zones.where(F.col("first") < F.lit(until))
    return sorted(r.file for r in zones.select("file").collect())


def read_timeline(spark: SparkSession, path: str, user: object, user_column: str = "user_id", played_at: str = "played_at",
                  since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """One user's plays, newest first, from the files that may hold them."""
    schema = spark.read.parquet(f"{path}/plays").schema
    wanted = F.lit(user).cast(schema[user_column].dataType)  # a hash depends on the type
    files = files_of(spark, path, wanted, since, until)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    rows = rows.where((F.col("user_bucket") == user_bucket(wanted)) & (F.col(user_column) == wanted))
    if since is not None:
        rows = rows.where(F.col(played_at) >= F.lit(since))
    if until is not None:
        rows = rows.where(F.col(played_at) < F.lit(until))
    return rows.drop("user_bucket").orderBy(F.desc_nulls_last(played_at))
