"""Rankings that a stream of plays keeps up: top lists per window, and each user's last plays.

**Top lists.** Counts per window and key come from a windowed count in update mode. A batch's
changed counts are merged with the stored lists of the windows it touches. Counts only grow, so
an entry that is neither in the old list nor changed cannot be in the new one: the stored list and
the changes are all that is needed, also when rows come late. Each merge also gives the
entries that the list takes back, takes in or moves, for readers that follow along.

**Last plays.** Each user has one row with the newest plays in a sorted array of bounded length. A
batch brings at most that many plays per user to the merge, whatever a user's share of it.
Plays that were stored before, or left the array earlier, change nothing, so batches may
overlap, come late or come again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playtide import schemas
from playtide.streaming.ingest import batch_name
from playtide.streaming.live import LiveTable
from playtide.streaming.windows import windowed_counts

_LATEST = (1 << 63) - 1  # place of a play without a time, behind all others


def _run(stream: DataFrame, mode: str, checkpoint: str, merge, once: bool) -> StreamingQuery:
    def each(batch: DataFrame, batch_id: int) -> None:
        merge(batch, batch_name(batch, batch_id).rsplit("-", 1)[0], batch_id)

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# --- top lists per window

def top_list_table(path: str, keys: Sequence[T.StructField]) -> LiveTable:
    """``window_start, window_end, rank, <keys>, plays, version``: one row per window and rank."""
    span = [T.StructField(c, T.TimestampType()) for c in ("window_start", "window_end")]
    schema = T.StructType([*span, T.StructField("rank", T.IntegerType()), *keys,
                           T.StructField("plays", T.LongType()), T.StructField("version", T.LongType())])
    return LiveTable(path, schema, ("window_start", "rank"), ("version",), keep="last")


def merge_top_lists(changed: DataFrame, table: LiveTable, keys: Sequence[str], n: int, writer: str, number: int) -> None:
    """Bring changed counts ``window_start, window_end, <keys>, plays`` into the lists of their windows.

    Most plays come first, then the smaller key. Rows of ``changes`` say what became of an entry:
    ``enter``, ``leave`` (its rank is then the one it had) or ``move``.
    """
    spark, version = changed.sparkSession, table.version(changed.sparkSession)
    if version.done.get(writer, -1) >= number:
        return
    span = ["window_start", "window_end"]
    changed = changed.select(*span, *keys, "plays").persist()
    try:
        # A window has at most n rows in the lists, whose windows are pruned to those of the batch.
        ranks = spark.range(1, n + 1).select(F.col("id").cast("int").alias("rank"))
        places = changed.select("window_start").distinct().join(F.broadcast(ranks))
        before = table.lookup(places).select(*span, *keys, "plays", F.col("rank").alias("old_rank"))
        counts = changed.withColumn("old_rank", F.lit(None).cast("int")).unionByName(before).groupBy(*span, *keys).agg(
            F.max("plays").alias("plays"), F.max("old_rank").alias("old_rank"))
        order = W.partitionBy("window_start").orderBy(F.desc("plays"), *keys)
        top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).persist()
        moved = (top.where("old_rank is distinct from rank")
                 .withColumn("change", F.when(F.col("old_rank").isNull(), F.lit("enter")).otherwise(F.lit("move"))))
        left = (before.join(top.select("window_start", *keys), ["window_start", *keys], "left_anti")
                .withColumn("rank", F.col("old_rank")).withColumn("change", F.lit("leave")))
        (moved.unionByName(left).select(*span, "rank", *keys, "plays", "change").write.mode("overwrite")
         .parquet(f"{table.path}/changes/writer={writer}/batch={number}"))
        table.write(top.select(*span, "rank", *keys, "plays", F.lit(version.number + 1).cast("bigint").alias("version")),
                    writer, number)
        top.unpersist()
    finally:
        changed.unpersist()


def keep_top_lists(plays: DataFrame, keys: Sequence[str], path: str, checkpoint: str, n: int = 10,
                   played_at: str = "played_at", window: str = "1 hour", delay: str = "1 hour",
                   once: bool = False) -> StreamingQuery:
    """Start keeping the ``n`` most played keys of every window; rows later than ``delay`` are dropped."""
    table = top_list_table(path, [plays.schema[k] for k in keys])
    counts = windowed_counts(plays, keys, played_at, window, delay)
    return _run(counts, "update", checkpoint,
                lambda batch, writer, number: merge_top_lists(batch, table, keys, n, writer, number), once)


def read_top_lists(spark: SparkSession, path: str, keys: Sequence[T.StructField]) -> DataFrame:
    return top_list_table(path, keys).read(spark).drop("version")


def read_changes(spark: SparkSession, path: str, keys: Sequence[T.StructField]) -> DataFrame:
    """What the lists took in, moved and took back, with the batch that did it."""
    fields = [f for f in top_list_table(path, keys).schema if f.name != "version"]
    schema = T.StructType([*fields, T.StructField("change", T.StringType()), T.StructField("writer", T.StringType()),
                           T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).option("basePath", f"{path}/changes").parquet(f"{path}/changes")


# --- last plays per user

def last_plays_table(path: str, play: Sequence[T.StructField], user: T.StructField) -> LiveTable:
    """``<user>, plays, version`` with the plays newest first; ``place`` orders them."""
    item = T.StructType([T.StructField("place", T.LongType()), *play])
    return LiveTable(path, T.StructType([user, T.StructField("plays", T.ArrayType(item)),
                                         T.StructField("version", T.LongType())]), (user.name,), ("version",), keep="last")


def merge_last_plays(batch: DataFrame, table: LiveTable, identity: Sequence[str], n: int, writer: str, number: int,
                     played_at: str = "played_at") -> None:
    """Bring plays into their users' arrays; a play is known by ``identity``, which also breaks ties in time."""
    version = table.version(batch.sparkSession)
    if version.done.get(writer, -1) >= number:
        return
    user = table.keys[0]
    fields = [f.name for f in table.schema["plays"].dataType.elementType if f.name != "place"]
    rest = [f for f in fields if f not in identity]
    place = F.coalesce(-F.unix_micros(F.col(played_at).cast("timestamp")), F.lit(_LATEST))
    newest = W.partitionBy(user).orderBy("place", *identity)
    same = W.partitionBy(user, "place", *identity).orderBy(*rest) if rest else W.partitionBy(user, "place", *identity).orderBy("place")
    rows = batch.withColumn("place", place).withColumn("copy", F.row_number().over(same)).where("copy = 1")
    rows = rows.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= n)
    fresh = rows.groupBy(user).agg(F.collect_list(F.struct("place", *fields)).alias("fresh")).persist()  # n at most
    try:
        stored = table.lookup(fresh.select(user)).select(user, F.col("plays").alias("old"))
        joined = fresh.join(stored, user, "left").withColumn("old", F.coalesce("old", F.array().cast(table.schema["plays"].dataType)))

        def name(item):
            return F.struct(item["place"], *[item[c] for c in identity])

        known = F.transform("old", name)
        new = F.filter("fresh", lambda item: ~F.array_contains(known, name(item)))
        # A struct sorts by its fields in order: the place first, then the identity.
        whole = F.transform(F.concat("old", new), lambda item: F.struct(
            item["place"].alias("place"), *[item[c].alias(c) for c in [*identity, *rest]]))
        ordered = F.transform(F.slice(F.sort_array(whole), 1, n), lambda item: F.struct(
            item["place"].alias("place"), *[item[c].alias(c) for c in fields]))
        changed = joined.where(F.size(new) > 0).select(
            user, ordered.alias("plays"), F.lit(version.number + 1).cast("bigint").alias("version"))
        table.write(changed, writer, number)
    finally:
        fresh.unpersist()


def keep_last_plays(plays: DataFrame, identity: Sequence[str], path: str, checkpoint: str,
                    n: int = schemas.RECENT_LIMIT, user: str = "user_id", once: bool = False) -> StreamingQuery:
    """Start keeping each user's newest ``n`` plays, with all columns of the stream."""
    table = last_plays_table(path, [f for f in plays.schema if f.name != user], plays.schema[user])
    return _run(plays, "append", checkpoint,
                lambda batch, writer, number: merge_last_plays(batch, table, identity, n, writer, number), once)


def read_last_plays(spark: SparkSession, path: str, play: Sequence[T.StructField], user: T.StructField) -> DataFrame:
    """One row per play with its position ``idx`` (0 is the newest): what leaderboards take."""
    rows = last_plays_table(path, play, user).read(spark)
    return rows.select(user.name, F.posexplode("plays").alias("idx", "play")).select(user.name, "idx", "play.*").drop("place")
