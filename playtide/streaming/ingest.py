"""Message streams into keyed tables, routed by topic; bad messages into a table of rejects."""

from __future__ import annotations

import signal
import threading
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playtide import schemas
from playtide.functions import all_present
from playtide.operators.tables import keep_first
from playtide.streaming import stores
from playtide.streaming.live import LiveTable

ARRIVAL = ["timestamp", "partition", "offset"]
PREVIEW_CHARS = 120
_PLACE = ("topic", "partition", "offset")
_STRICT = {"allowSingleQuotes": "false"}


@dataclass(frozen=True)
class Route:
    """Where messages of a topic go. ``mode`` is ``insert`` (first one stays) or ``latest``.

    ``day_of`` is the key column whose day partitions an insert table. With
    ``event_type`` set, messages of another type are rejected.
    """

    topic: str
    table: str
    schema: T.StructType
    keys: tuple[str, ...]
    mode: str = "insert"
    day_of: str | None = None
    event_type: str | None = None

    def __post_init__(self) -> None:
        if self.mode not in ("insert", "latest"):
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.mode == "insert" and self.day_of not in self.keys:
            raise ValueError("an insert route needs day_of, one of its keys")

    @property
    def stored(self) -> T.StructType:
        """Message fields followed by the arrival columns."""
        return T.StructType([*self.schema.fields,
                             *[schemas.MESSAGE[c] for c in ARRIVAL]])


def play_event_route(topic: str, table: str = "play_events") -> Route:
    return Route(topic, table, schemas.PLAY_EVENT, ("user_id", "track_id", "played_at"),
                 "insert", day_of="played_at")


def top_tracks_route(topic: str, table: str = "top_tracks") -> Route:
    return Route(topic, table, schemas.TOP_TRACKS_DOCUMENT, ("user_id", "artist_id", "market"),
                 "latest", event_type=schemas.TOP_TRACKS_EVENT_TYPE)


def parse_messages(messages: DataFrame, routes: Sequence[Route]) -> DataFrame:
    """Each message read once with the schema of its topic.

    Fields are under ``data_<n>`` for the n-th route; ``reason`` is set where the
    message must be rejected.
    """
    data = F.struct(*[
        F.when(F.col("topic") == route.topic, F.from_json("value", _with_corrupt(route.schema), {
            **_STRICT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})).alias(f"data_{i}")
        for i, route in enumerate(routes)])
    # A parser with a schema stops at the end of the first object. As the one element of an
    # array the whole text must be JSON, and one value.
    alone = F.size(F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>", _STRICT)) == 1
    whole = F.coalesce(alone & F.col("value").rlike(r"\A[ \t\r\n]*\{"), F.lit(False))
    # As a generated row the fields are parsed once, not again in every filter on them.
    parsed = messages.select(
        "topic", *ARRIVAL, F.substring("value", 1, PREVIEW_CHARS).alias("value_preview"), "value",
        whole.alias("_object"),
        F.inline(F.array(data)))
    reason = F.lit(None).cast("string")
    known = F.lit(False)
    for i, route in enumerate(routes):
        mine = F.coalesce(F.col("topic") == route.topic, F.lit(False))
        known = known | mine
        reason = F.when(mine, _reason(route, f"data_{i}")).otherwise(reason)
    reason = F.when(known, reason).otherwise(F.lit("unknown topic"))
    return parsed.withColumn("reason", reason).drop("_object")


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])


def _reason(route: Route, data: str) -> Column:
    malformed = F.col(data).isNull() | F.col(f"{data}._corrupt").isNotNull() | ~F.col("_object")
    reason = F.when(malformed, "malformed")
    if route.event_type:
        same = F.col(f"{data}.event_type").eqNullSafe(F.lit(route.event_type))
        reason = reason.when(~same, "unexpected event type")
    return reason.when(~all_present([F.col(f"{data}.{k}") for k in route.keys]), "missing key")


def accepted(parsed: DataFrame, routes: Sequence[Route], route: Route) -> DataFrame:
    """Rows for the table of one route."""
    data = F.col(f"data_{list(routes).index(route)}")
    return parsed.where((F.col("topic") == route.topic) & F.col("reason").isNull()).select(
        *[data[f.name].alias(f.name) for f in route.schema], *ARRIVAL)


def rejected(parsed: DataFrame) -> DataFrame:
    """Rejects of a batch, the whole message with them: malformed, wrong type, missing key, or of an unknown topic."""
    return parsed.where(F.col("reason").isNotNull()).select(
        "topic", *ARRIVAL, "reason", "value_preview", "value")


def write_batch(messages: DataFrame, routes: Sequence[Route], base: str, ingest: str) -> None:
    """Write one batch of messages to all tables; writing it again changes nothing."""
    parsed = parse_messages(messages, routes).persist()
    try:
        _write_accepted(parsed, routes, base, ingest)
        rejected(parsed).write.mode("overwrite").parquet(f"{base}/rejects/ingest={ingest}")
    finally:
        parsed.unpersist()


def _write_accepted(parsed: DataFrame, routes: Sequence[Route], base: str, ingest: str) -> None:
    for route in routes:
        rows = accepted(parsed, routes, route)
        path = f"{base}/{route.table}"
        if route.mode == "insert":
            stores.insert_if_absent(rows, path, route.keys, ARRIVAL, f"{ingest}-{route.topic}", route.day_of)
        else:
            stores.upsert_latest(rows, path, route.keys, ARRIVAL, f"{ingest}-{route.topic}")


_ATTEMPT = T.StructType([*[schemas.MESSAGE[c] for c in ("topic", "partition", "offset")],
                         T.StructField("attempt", T.IntegerType()), T.StructField("reason", T.StringType())])


def _attempts(base: str) -> LiveTable:
    """What later attempts made of rejects; a null reason means that the message was taken up."""
    return LiveTable(f"{base}/attempts", _ATTEMPT, _PLACE, ("attempt",), "last")


def open_rejects(spark: SparkSession, base: str) -> DataFrame:
    """Rejects that no replay has taken up, with the number of attempts and the reason of the last one."""
    tried = _attempts(base).read(spark).withColumnsRenamed({"reason": "last_reason"})
    rows = keep_first(read_rejects(spark, base), list(_PLACE), ["timestamp"]).join(tried, list(_PLACE), "left")
    return (rows.where("attempt is null or last_reason is not null")
            .withColumn("reason", F.coalesce("last_reason", "reason"))
            .withColumn("attempt", F.coalesce("attempt", F.lit(0))).drop("last_reason"))


def replay_rejects(spark: SparkSession, routes: Sequence[Route], base: str, run: int) -> None:
    """Read all open rejects again with routes that may know more topics or fields.

    Messages that are accepted now go to the tables of their routes and leave the rejects; the
    others stay, with one attempt more. ``run`` numbers the replays: after a failure the same number
    is given again, which replaces what was written, and a run that had ended is not repeated.
    """
    attempts = _attempts(base)
    if attempts.version(spark).done.get("replay", -1) >= run:
        return
    rows = open_rejects(spark, base)
    parsed = parse_messages(rows.select("topic", *ARRIVAL, "value"), routes).persist()
    try:
        _write_accepted(parsed, routes, base, f"replay-{run}")
        before = rows.select(*_PLACE, "attempt")
        attempts.write(parsed.select(*_PLACE, "reason").join(before, list(_PLACE)).select(
            *_PLACE, (F.col("attempt") + 1).alias("attempt"), "reason"), "replay", run)
    finally:
        parsed.unpersist()


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """A name for the batch that is the same on a retry and differs between checkpoints."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def ingest(stream: DataFrame, routes: Sequence[Route], base: str, checkpoint: str,
           once: bool = False, interval: str | None = None) -> StreamingQuery:
    """Start writing a message stream to the tables of ``routes`` below ``base``.

    Progress is committed after a batch is written, and batches can be written
    again, so each message counts once. A failing store fails the query, which is
    to be restarted on the same checkpoint. ``once`` stops at the end of the input.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: write_batch(batch, routes, base, batch_name(batch, batch_id)))
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for the query; SIGINT and SIGTERM stop it after the current batch's step."""
    stopping = threading.Event()
    before = {number: signal.signal(number, lambda *_: stopping.set()) for number in (signal.SIGINT, signal.SIGTERM)}
    try:
        while query.isActive and not stopping.wait(1.0):
            pass
    finally:
        for number, handler in before.items():
            signal.signal(number, handler)
    if query.isActive:
        query.stop()
    elif query.exception():
        raise query.exception()


def read_table(spark: SparkSession, route: Route, base: str) -> DataFrame:
    """Current rows of a route's table."""
    path = f"{base}/{route.table}"
    if route.mode == "insert":
        return stores.read_inserted(spark, path, route.stored)
    return stores.read_latest(spark, path, route.stored, route.keys, ARRIVAL)


def read_rejects(spark: SparkSession, base: str) -> DataFrame:
    schema = T.StructType([
        schemas.MESSAGE["topic"], *[schemas.MESSAGE[c] for c in ARRIVAL],
        *[T.StructField(c, T.StringType()) for c in ("reason", "value_preview", "value")]])
    path = f"{base}/rejects"
    return (spark.read.schema(T.StructType([*schema.fields, T.StructField("ingest", T.StringType())]))
            .option("basePath", path).parquet(path).drop("ingest"))
