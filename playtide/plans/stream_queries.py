"""Queries that run the events as a message stream into keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.operators import plays as listening
from playtide.plans import bindings as b
from playtide.plans.listening_queries import LINES_SQL_TRACKS, shown_tracks
from playtide.plans.registry import query
from playtide.schemas import TOP_TRACKS_EVENT_TYPE
from playtide.session import work_path
from playtide.sources import streams
from playtide.streaming import rankings, stores, windows
from playtide.streaming.live import LiveTable
from playtide.streaming.rollups import PlayRollup
from playtide.streaming import ingest as flow

PLAYS_ROUTE = flow.play_event_route("plays")
TOP_ROUTE = flow.top_tracks_route("tops")
ROUTES = [PLAYS_ROUTE, TOP_ROUTE]


def event_stream(spark, sf_dir) -> DataFrame:
    """The events table as a file stream."""
    schema = b.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")


def messages(events: DataFrame) -> DataFrame:
    """Events as messages of two topics, some of them broken or of an unknown topic."""
    k = F.get_json_object("props", "$.k").cast("int")
    play = F.to_json(F.struct(
        F.lit("recent_play").alias("event_type"), F.col("user_id").cast("string").alias("user_id"),
        F.when(k % 10 == 9, F.lit("")).otherwise((k % 5).cast("string")).alias("track_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("played_at"),
        F.floor("value").alias("track_duration_ms")))
    top = F.to_json(F.struct(
        F.when(F.col("value") > 100, F.lit("other")).otherwise(F.lit(TOP_TRACKS_EVENT_TYPE)).alias("event_type"),
        F.col("user_id").cast("string").alias("user_id"), (k % 3).cast("string").alias("artist_id"),
        F.lit("AT").alias("market"), F.col("event_id").cast("string").alias("artist_name")))
    kind = F.col("event_type")
    return events.select(
        F.when(kind == "signup", F.lit("tops")).when(kind == "error", F.lit("errors"))
        .otherwise(F.lit("plays")).alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(kind == "signup", top)
        .when((kind == "click") & (F.col("value") < 5), F.substring(play, 1, 30))
        .when(k % 100 == 16, F.concat(play, F.lit(" xyz"))).when(k % 100 == 25, F.concat(play, play))
        .when(k % 100 == 37, F.concat(F.lit("\n\t"), play, F.lit("\r\n")))
        .otherwise(play).alias("value"))


def _ingested(spark, sf_dir) -> str:
    base = work_path(spark, "ingest")
    started = flow.ingest(messages(event_stream(spark, sf_dir)), ROUTES, f"{base}/tables",
                          f"{base}/progress", once=True)
    started.awaitTermination()
    return f"{base}/tables"


_MESSAGES = """
m AS (
  SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, *,
         (event_type = 'click' AND value < 5)
           OR CAST(json_extract_string(props, '$.k') AS INTEGER) % 100 IN (16, 25) AS broken
  FROM events)"""
_FIRST = """
SELECT user_id, track_id, played_at, track_duration_ms FROM (
  SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(k % 5 AS VARCHAR) AS track_id,
         strftime(ts, '%Y-%m-%d') AS played_at, CAST(floor(value) AS BIGINT) AS track_duration_ms,
         row_number() OVER (PARTITION BY user_id, k % 5, strftime(ts, '%Y-%m-%d')
                            ORDER BY ts, event_id) AS rn
  FROM m WHERE event_type NOT IN ('signup', 'error') AND NOT broken AND k % 10 <> 9)
WHERE rn = 1"""
_PLAY_COLUMNS = ["user_id", "track_id", "played_at", "track_duration_ms"]


@query(f"WITH {_MESSAGES} {_FIRST}")
def stream_ingest(spark, sf_dir):
    return flow.read_table(spark, PLAYS_ROUTE, _ingested(spark, sf_dir)).select(*_PLAY_COLUMNS)


@query(f"""
WITH {_MESSAGES}
SELECT user_id, artist_id, market, artist_name FROM (
  SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(k % 3 AS VARCHAR) AS artist_id, 'AT' AS market,
         CAST(event_id AS VARCHAR) AS artist_name,
         row_number() OVER (PARTITION BY user_id, k % 3 ORDER BY ts DESC, event_id DESC) AS rn
  FROM m WHERE event_type = 'signup' AND value <= 100) WHERE rn = 1""")
def latest_snapshot(spark, sf_dir):
    return flow.read_table(spark, TOP_ROUTE, _ingested(spark, sf_dir)).select(
        "user_id", "artist_id", "market", "artist_name")


@query(f"""
WITH {_MESSAGES}
SELECT CASE event_type WHEN 'signup' THEN 'tops' WHEN 'error' THEN 'errors' ELSE 'plays' END AS topic,
       event_id AS "offset",
       CASE WHEN event_type = 'error' THEN 'unknown topic'
            WHEN event_type = 'signup' THEN 'unexpected event type'
            WHEN broken THEN 'malformed' ELSE 'missing key' END AS reason
FROM m WHERE event_type = 'error' OR (event_type = 'signup' AND value > 100)
          OR (event_type NOT IN ('signup', 'error') AND (broken OR k % 10 = 9))""")
def dead_letters(spark, sf_dir):
    return flow.read_rejects(spark, _ingested(spark, sf_dir)).select("topic", "offset", "reason")


@query(f"WITH {_MESSAGES} {_FIRST}")
def file_messages(spark, sf_dir):
    """Message files of three periods, written one after the other, streamed one file per batch."""
    base = work_path(spark, "messages")
    every = messages(b.table(spark, sf_dir, "events"))
    bounds = ["1970-01-01", "2024-01-11", "2024-01-21", "9999-01-01"]
    for low, high in zip(bounds, bounds[1:]):
        part = every.where((F.col("timestamp") >= low) & (F.col("timestamp") < high))
        part.coalesce(1).write.mode("append").json(f"{base}/in")
    stream = streams.file_stream(spark, f"{base}/in", max_files_per_trigger=1)
    flow.ingest(stream, ROUTES, f"{base}/tables", f"{base}/progress", once=True).awaitTermination()
    return flow.read_table(spark, PLAYS_ROUTE, f"{base}/tables").select(*_PLAY_COLUMNS)


@query("SELECT event_id, user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS generated_at FROM events WHERE event_type = 'signup'")
def newest_snapshots(spark, sf_dir):
    rows = b.table(spark, sf_dir, "events").where("event_type = 'signup'").select(
        "event_id", "user_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"))
    return listening.newest_first(rows, tiebreak=["event_id"])


def _accepted(spark, sf_dir) -> DataFrame:
    parsed = flow.parse_messages(messages(b.table(spark, sf_dir, "events")), ROUTES)
    return flow.accepted(parsed, ROUTES, PLAYS_ROUTE)


@query(f"WITH {_MESSAGES} {_FIRST}")
def insert_if_absent(spark, sf_dir):
    """The older part first, then everything, then everything again as a retry."""
    path = work_path(spark, "plays")
    rows = _accepted(spark, sf_dir)
    older = rows.where(F.col("played_at") < "2024-01-16")
    for part, name in ((older, "run-0"), (rows, "run-1"), (rows, "run-1")):
        stores.insert_if_absent(part, path, PLAYS_ROUTE.keys, flow.ARRIVAL, name, "played_at")
    return stores.read_inserted(spark, path, PLAYS_ROUTE.stored).select(*_PLAY_COLUMNS)


@query("""
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def upsert_latest(spark, sf_dir):
    """Two batches, the older one arriving again afterwards, then compaction."""
    path = work_path(spark, "latest")
    rows = b.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    older, newer = rows.where(F.col("ts") < middle), rows.where(F.col("ts") >= middle)
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    for part, name in ((older, "run-0"), (newer, "run-1"), (older, "again-0")):
        stores.upsert_latest(part, path, keys, order, name)
    stores.compact_latest(spark, path, rows.schema, keys, order)
    return stores.read_latest(spark, path, rows.schema, keys, order).drop("ts")


@query("""
SELECT event_type, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, count(*) AS plays
FROM events GROUP BY 1, 2""")
def stream_counts(spark, sf_dir):
    """Plays per hour and type, counted by a stream in update mode."""
    base = work_path(spark, "counts")
    plays = event_stream(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("played_at"), "event_type")
    counts = windows.windowed_counts(plays, ["event_type"])
    windows.keep_counts(counts, ["event_type"], f"{base}/table", f"{base}/progress",
                        once=True).awaitTermination()
    table = windows.read_counts(spark, f"{base}/table", counts.schema, ["event_type"])
    return table.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "plays")


@query("""
SELECT user_id, event_type, count(*) AS n FROM (
  SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events) GROUP BY 1, 2""")
def stream_distinct(spark, sf_dir):
    """Streaming duplicates per user, type and day, without a horizon: through the exact insert form."""
    base = work_path(spark, "distinct")
    plays = event_stream(spark, sf_dir).select(
        F.date_format("ts", "yyyy-MM-dd").alias("played_on"), "user_id", "event_type", "event_id")
    windows.insert_distinct(plays, ["user_id", "event_type", "played_on"], ["event_id"], "played_on",
                            f"{base}/table", f"{base}/progress", once=True).awaitTermination()
    table = stores.read_inserted(spark, f"{base}/table", plays.schema)
    return table.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("""
SELECT user_id, event_type, count(*) AS n FROM (
  SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events) GROUP BY 1, 2""")
def stream_distinct_horizon(spark, sf_dir):
    """The form with bounded state. Keys are forgotten a day of event time after they were first
    seen; within one batch, as here, none is dropped and each key passes once."""
    base = work_path(spark, "horizon")
    plays = event_stream(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias("played_at"), "user_id", "event_type",
        F.to_date("ts").alias("day"))
    unique = windows.distinct_plays(plays, ["user_id", "event_type", "day"])
    (unique.writeStream.format("parquet").option("path", f"{base}/table")
     .option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
     .awaitTermination())
    return (spark.read.schema(unique.schema).parquet(f"{base}/table")
            .groupBy("user_id", "event_type").agg(F.count("*").alias("n")))


_PARTS = 3  # runs of a stream: every run brings plays of all times, so most come late


def _in_runs(spark, rows: DataFrame, base: str, start) -> None:
    """Hand rows to a stream in several runs, dealt by a hash."""
    place = F.pmod(F.xxhash64(*rows.columns), F.lit(_PARTS))
    for part in range(_PARTS):
        rows.where(place == part).write.mode("append").parquet(f"{base}/in")
        start(spark.readStream.schema(rows.schema).parquet(f"{base}/in")).awaitTermination()


def _credits(spark, sf_dir) -> DataFrame:
    plays = b.plays(spark, sf_dir).withColumn("played_at", F.col("played_at").cast("timestamp"))
    return plays.select("event_id", "played_at", F.posexplode("artists").alias("pos", "artist")).select(
        "event_id", "pos", "played_at", F.col("artist.id").alias("artist_id")).where("artist_id <> ''")


def _top_list(spark, rows: DataFrame, key: str, n: int) -> DataFrame:
    base = work_path(spark, "toplist")
    _in_runs(spark, rows, base, lambda stream: rankings.keep_top_lists(
        stream, [key], f"{base}/lists", f"{base}/progress", n, window="1 day", delay="4000 days", once=True))
    lists = rankings.read_top_lists(spark, f"{base}/lists", [rows.schema[key]])
    return lists.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                        F.col("rank").cast("bigint").alias("rank"), key, "plays")


def _top_sql(source: str, key: str, n: int) -> str:
    return f"""
SELECT * FROM (
  SELECT CAST(date_trunc('day', played_at) AS TIMESTAMP) AS window_start,
         row_number() OVER (PARTITION BY date_trunc('day', played_at) ORDER BY count(*) DESC, {key}) AS rank,
         {key}, count(*) AS plays FROM {source} GROUP BY date_trunc('day', played_at), {key}) WHERE rank <= {n}"""


@query(f"WITH {b.PLAYS} {_top_sql('plays', 'track_id', 10)}")
def stream_top_tracks(spark, sf_dir):
    """Most played tracks of every day, kept up over runs that bring late plays."""
    rows = b.plays(spark, sf_dir).select("event_id", F.col("played_at").cast("timestamp").alias("played_at"), "track_id")
    return _top_list(spark, rows, "track_id", 10)


@query(f"""WITH {b.PLAYS}, credits AS (
  SELECT played_at, artist_1 AS artist_id FROM plays WHERE artist_1 <> ''
  UNION ALL SELECT played_at, artist_2 FROM plays WHERE artist_2 <> '') {_top_sql('credits', 'artist_id', 5)}""")
def stream_top_artists(spark, sf_dir):
    """Most credited artists of every day."""
    return _top_list(spark, _credits(spark, sf_dir), "artist_id", 5)


@query(LINES_SQL_TRACKS)
def stream_track_leaderboard(spark, sf_dir):
    """The track leaderboard out of each user's last plays, which a stream of unordered, partly repeated plays keeps up."""
    base = work_path(spark, "last-plays")
    rows = b.plays(spark, sf_dir)

    def start(stream: DataFrame):
        return rankings.keep_last_plays(stream, ["event_id"], f"{base}/last", f"{base}/progress", once=True)

    _in_runs(spark, rows, base, start)
    # Everything again under another writer: no play counts twice.
    table = rankings.last_plays_table(f"{base}/last", [f for f in rows.schema if f.name != "user_id"], rows.schema["user_id"])
    rankings.merge_last_plays(rows, table, ["event_id"], 50, "again", 0)
    last = rankings.read_last_plays(spark, f"{base}/last", [f for f in rows.schema if f.name != "user_id"],
                                    rows.schema["user_id"])
    stats = listening.listening_stats(last, "track_id", ["track_name", "track_artists"])
    return shown_tracks(listening.leaderboard(stats, "track_name"))


@query("""
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def live_latest(spark, sf_dir):
    """The last row per key over batches in any order, through tiers of merged folders."""
    rows = b.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    table = LiveTable(work_path(spark, "live"), rows.schema, ("user_id", "event_type"), ("ts", "event_id"), "last")
    place = F.pmod(F.xxhash64("event_id"), F.lit(5))
    for number in range(5):
        table.write(rows.where(place == number), "batches", number)
    table.write(rows.where(place == 4), "batches", 4)  # comes again
    return table.read(spark).drop("ts")


@query(f"WITH {_MESSAGES} {_FIRST}")
def live_insert(spark, sf_dir):
    """Insert if absent through key buckets: the older part, then everything."""
    rows = _accepted(spark, sf_dir)
    table = LiveTable(work_path(spark, "live"), rows.schema, PLAYS_ROUTE.keys, tuple(flow.ARRIVAL))
    table.write(rows.where(F.col("played_at") < "2024-01-16"), "batches", 0)
    table.write(rows, "batches", 1)
    return table.read(spark).select(*_PLAY_COLUMNS)


@query(f"""
WITH {_MESSAGES},
first AS ({_FIRST}),
late AS (
  SELECT user_id, track_id, played_at, track_duration_ms FROM (
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(k % 5 AS VARCHAR) AS track_id,
           strftime(ts, '%Y-%m-%d') AS played_at, CAST(floor(value) AS BIGINT) AS track_duration_ms,
           row_number() OVER (PARTITION BY user_id, k % 5, strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS rn
    FROM m WHERE event_type = 'error' AND NOT broken AND k % 10 <> 9) WHERE rn = 1)
SELECT * FROM first UNION ALL SELECT * FROM late ANTI JOIN first USING (user_id, track_id, played_at)""")
def replayed_rejects(spark, sf_dir):
    """Plays after messages of a topic without a route were taken up by a later one, whose run came twice."""
    base = _ingested(spark, sf_dir)
    more = [*ROUTES, flow.play_event_route("errors")]
    for run in (0, 0, 1):
        flow.replay_rejects(spark, more, base, run)
    return flow.read_table(spark, PLAYS_ROUTE, base).select(*_PLAY_COLUMNS)


@query(f"""
WITH {_MESSAGES}
SELECT CASE event_type WHEN 'signup' THEN 'tops' WHEN 'error' THEN 'errors' ELSE 'plays' END AS topic, event_id AS "offset",
       CASE WHEN event_type = 'signup' THEN 'unexpected event type'
            WHEN broken THEN 'malformed' ELSE 'missing key' END AS reason, 1 AS attempt
FROM m WHERE (event_type = 'signup' AND value > 100) OR (event_type <> 'signup' AND (broken OR k % 10 = 9))""")
def open_rejects(spark, sf_dir):
    """Rejects that a replay with one route more could not take up either."""
    base = _ingested(spark, sf_dir)
    flow.replay_rejects(spark, [*ROUTES, flow.play_event_route("errors")], base, 0)
    return flow.open_rejects(spark, base).select("topic", "offset", "reason", "attempt")


def _rolled_up(spark, sf_dir) -> PlayRollup:
    """Plays added in three batches that all reach over every day, the second one twice."""
    rows = b.plays(spark, sf_dir).select("track_id", "played_at", "user_id", "event_id")
    rollup = PlayRollup(work_path(spark, "rollup"), rows.schema["track_id"], rows.schema["user_id"])
    place = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for number in (0, 1, 1, 2):
        rollup.add(rows.where(place == number), "batches", number)
    return rollup


@query(f"""
WITH {b.PLAYS}, d AS (SELECT track_id, CAST(played_at AS DATE) AS day, count(*) AS plays FROM plays GROUP BY 1, 2)
SELECT track_id, day, plays, round(sum(plays) OVER (PARTITION BY track_id ORDER BY day
         RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) / 7, 6) AS moving_average FROM d""")
def rolled_daily_plays(spark, sf_dir):
    """Daily plays and moving averages out of day tables that batches were added to."""
    return _rolled_up(spark, sf_dir).daily_plays(spark).withColumn("moving_average", F.round("moving_average", 6))


@query(f"""
WITH {b.PLAYS} SELECT track_id, CAST(date_trunc('week', played_at) AS DATE) AS week, count(DISTINCT user_id) AS listeners,
       true AS estimate_is_near FROM plays GROUP BY 1, 2""")
def rolled_listeners(spark, sf_dir):
    """Listeners per track and week, exactly, and whether the union of the days' sketches is within 3 %."""
    rollup, week = _rolled_up(spark, sf_dir), F.to_date(F.date_trunc("week", "day"))
    exact = rollup.listener_counts(spark, week)
    near = rollup.listener_estimates(spark, week).withColumnRenamed("listeners", "estimate")
    return exact.join(near, ["track_id", "period"]).select(
        "track_id", F.col("period").alias("week"), "listeners",
        (F.abs(F.col("estimate") - F.col("listeners")) <= 0.03 * F.col("listeners")).alias("estimate_is_near"))
