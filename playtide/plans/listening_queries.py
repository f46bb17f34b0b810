"""Queries over plays: leaderboards, artists, events, scalar functions."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide import functions as P
from playtide.operators import catalog, clustering, plays as listening, tables
from playtide.plans import bindings as b
from playtide.plans import pipelines
from playtide.plans.registry import query
from playtide.schemas import ARTIST_TOP_TRACKS, RECENT_ITEM, RECENT_LIMIT, TOP_TRACKS, TOP_TRACKS_EVENT_TYPE
from playtide.session import work_path
from playtide.sources import payloads
from playtide.sources.files import topic_messages as as_messages

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SQL_ISO = "%Y-%m-%dT%H:%M:%S.%f"


def _lines(board, name, artists):
    texts = board.withColumn("latest_played_at", F.date_format("latest_played_at", ISO))
    return listening.leaderboard_lines(texts, name, artists)


def _board_sql(key: str, name: str, artists: str) -> str:
    return f"""
WITH {b.LAST_50},
stats AS (
  SELECT user_id, {key}, count(*) AS plays, min(idx) AS first_idx,
         arg_min(played_at, idx) AS latest, arg_min({name}, idx) AS name,
         arg_min({artists}, idx) AS artists
  FROM last_plays WHERE {key} <> '' GROUP BY user_id, {key}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY plays DESC, first_idx, lower(name))
    AS rank FROM stats)
SELECT user_id, rank, {key}, plays, CAST(first_idx AS BIGINT) AS first_idx,
       strftime(latest, '{SQL_ISO}') AS latest_played_at,
       printf('%02d. %s — %s  | plays=%d  | latest=%s', rank, name, artists, plays,
              strftime(latest, '{SQL_ISO}')) AS line
FROM ranked WHERE rank <= 10"""


def _shown(board, key):
    return board.select("user_id", F.col("rank").cast("bigint").alias("rank"), key, "plays",
                        F.col("first_idx").cast("bigint").alias("first_idx"),
                        "latest_played_at", "line")


LINES_SQL_TRACKS = _board_sql("track_id", "track_name", "track_artists")


def shown_tracks(board):
    return _shown(_lines(board, "track_name", "track_artists"), "track_id")


@query(LINES_SQL_TRACKS)
def track_leaderboard(spark, sf_dir):
    return shown_tracks(pipelines.track_leaderboard(b.plays(spark, sf_dir), tiebreak=["event_id"]))


@query(_board_sql("album_id", "album_name", "album_artists"))
def album_leaderboard(spark, sf_dir):
    board = pipelines.album_leaderboard(b.plays(spark, sf_dir), tiebreak=["event_id"])
    return _shown(_lines(board, "album_name", "album_artists"), "album_id")


def _recent(spark, sf_dir):
    return listening.last_n_plays(b.plays(spark, sf_dir), tiebreak=["event_id"])


_RANKED_ARTISTS = b.CREDITS + """,
counts AS (SELECT user_id, artist_id, count(*) AS plays, min(idx * 10 + pos) AS seen
           FROM credits GROUP BY user_id, artist_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY plays DESC, seen) AS rank
           FROM counts)"""


@query(f"WITH {_RANKED_ARTISTS} SELECT user_id, artist_id, plays FROM ranked WHERE rank = 1")
def dominant_artist(spark, sf_dir):
    return listening.dominant_artist(_recent(spark, sf_dir))


# Artist names: brands are the known artists, so a9 for instance is 'Brand#9'.
_ARTISTS = """
artists AS (SELECT 'a' || (CAST(substr(p_brand, 7) AS INTEGER)) AS artist_id, p_brand AS artist_name
            FROM part GROUP BY p_brand)"""


def _artists(spark, sf_dir):
    brand = F.col("p_brand")
    return (b.table(spark, sf_dir, "part").select(brand.alias("artist_name")).distinct()
            .withColumn("artist_id", F.concat(F.lit("a"), F.substring("artist_name", 7, 9))))


@query(f"""
WITH {_RANKED_ARTISTS}, {_ARTISTS}
SELECT user_id, rank, artist_id, plays, coalesce(artist_name, '?') AS artist_name
FROM ranked LEFT JOIN artists USING (artist_id) WHERE rank <= 5""")
def top_artists(spark, sf_dir):
    top = listening.top_artists(_recent(spark, sf_dir), 5)
    named = listening.with_names(top, _artists(spark, sf_dir), "artist_id", "artist_name")
    return named.select("user_id", F.col("rank").cast("bigint").alias("rank"), "artist_id",
                        "plays", "artist_name")


def _catalog(spark, sf_dir):
    """Parts as tracks per artist (brand) and market (type), largest size first."""
    part = b.table(spark, sf_dir, "part")
    artist = F.concat(F.lit("a"), F.substring("p_brand", 7, 9))
    artists = F.array(F.struct(artist.alias("id"), F.col("p_brand").alias("name")))
    track = F.struct(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
        F.floor(F.col("p_retailprice") * 100).alias("duration_ms"), artists.alias("artists"),
        F.struct(F.col("p_type").alias("id"), F.lower("p_type").alias("name"),
                 F.lit(None).cast("string").alias("release_date"), artists.alias("artists")).alias("album"))
    return part.select(artist.alias("artist_id"),
                       F.substring("p_type", 1, 1).alias("market"),
                       F.struct(-F.col("p_size"), "p_partkey").alias("position"),
                       track.alias("track"))


_CATALOG = """
catalog AS (
  SELECT 'a' || (CAST(substr(p_brand, 7) AS INTEGER)) AS artist_id, substr(p_type, 1, 1) AS market,
         CAST(p_partkey AS VARCHAR) AS track_id, p_name AS track_name, p_brand AS brand,
         CAST(floor(p_retailprice * 100) AS BIGINT) AS duration_ms, p_type AS album_id,
         row_number() OVER (PARTITION BY p_brand, substr(p_type, 1, 1)
                            ORDER BY p_size DESC, p_partkey) AS rank
  FROM part)"""

# Markets: the override is blank for some users, the country missing for others.
_MARKETS = """
markets AS (
  SELECT user_id, CASE WHEN override <> '' THEN override WHEN country <> '' THEN country ELSE 'E' END
    AS market, country
  FROM (SELECT c_custkey AS user_id,
               CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE substr(c_mktsegment, 1, 1) END AS override,
               CASE WHEN c_nationkey % 2 = 0 THEN NULL ELSE 'S' END AS country FROM customer))"""


def _markets(spark, sf_dir):
    nation = F.col("c_nationkey")
    override = F.when(nation % 3 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit(" "), F.substring("c_mktsegment", 1, 1)))
    country = F.when(nation % 2 != 0, F.lit("S"))
    return b.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), country.alias("country"),
        P.market_used(override, country, default="E").alias("market"))


@query(f"WITH {_MARKETS} SELECT user_id, country, market FROM markets")
def market_fallback(spark, sf_dir):
    return _markets(spark, sf_dir)


_TOP_TRACKS = f"""
WITH {_RANKED_ARTISTS}, {_CATALOG}, {_MARKETS},
dominant AS (SELECT user_id, artist_id, market, country FROM ranked JOIN markets USING (user_id)
             WHERE ranked.rank = 1)"""


@query(_TOP_TRACKS + """
SELECT user_id, d.artist_id, d.market, rank, track_id, track_name, duration_ms, album_id,
       printf('%02d. %s — %s (%02d:%02d)', rank, track_name, brand, duration_ms // 60000,
              (duration_ms // 1000) % 60) AS line
FROM dominant d JOIN catalog c ON d.artist_id = c.artist_id AND d.market = c.market
WHERE rank <= 10""")
def artist_top_tracks(spark, sf_dir):
    dominant = listening.dominant_artist(_recent(spark, sf_dir)).join(_markets(spark, sf_dir), "user_id")
    ranked = catalog.artist_top_tracks(dominant, _catalog(spark, sf_dir), TOP_TRACKS)
    return catalog.track_lines(ranked).select(
        "user_id", "artist_id", "market", F.col("rank").cast("bigint").alias("rank"),
        F.col("track.id").alias("track_id"), F.col("track.name").alias("track_name"),
        F.col("track.duration_ms").alias("duration_ms"), F.col("track.album.id").alias("album_id"),
        "line")


@query(_TOP_TRACKS + f""", {_ARTISTS},
lists AS (SELECT artist_id, market, count(*) AS n_tracks,
                 string_agg(rank || ':' || track_id || ':' || brand, ',' ORDER BY rank) AS tracks
          FROM catalog WHERE rank <= 10 GROUP BY artist_id, market)
SELECT '1.0' AS event_version, '{TOP_TRACKS_EVENT_TYPE}' AS event_type,
       '2024-02-01T00:00:00.000000+00:00' AS generated_at, user_id, country, d.market, d.artist_id,
       coalesce(artist_name, '?') AS artist_name, coalesce(n_tracks, 0) AS n_tracks,
       coalesce(tracks, '') AS tracks
FROM dominant d LEFT JOIN artists USING (artist_id)
LEFT JOIN lists l ON d.artist_id = l.artist_id AND d.market = l.market""")
def top_tracks_document(spark, sf_dir):
    now = F.to_timestamp_ltz(F.lit("2024-02-01T00:00:00Z"))
    documents = pipelines.dominant_artist_documents(
        b.plays(spark, sf_dir), _markets(spark, sf_dir), _artists(spark, sf_dir),
        _catalog(spark, sf_dir), tiebreak=["event_id"], now=now)
    text = F.transform("tracks", lambda t: F.concat_ws(
        ":", t["rank"].cast("string"), t["track_id"], F.array_join(t["artists"], "/")))
    return documents.select(
        *[c for c in documents.columns if c != "tracks"],
        F.size("tracks").cast("bigint").alias("n_tracks"), F.array_join(text, ",").alias("tracks"))


def _payload_texts(plays):
    """Recent-plays payload texts out of plays with ``page`` and ``idx``, items in that order."""
    track = F.struct(
        F.col("track_id").alias("id"), F.col("track_name").alias("name"),
        F.when(F.col("duration_ms") > 20, F.floor("duration_ms")).alias("duration_ms"), "artists",
        F.when(F.col("album_id") != "error", F.struct(
            F.col("album_id").alias("id"), F.col("album_name").alias("name"),
            F.lit("2020").alias("release_date"))).alias("album"))
    item = F.struct("idx", F.date_format("played_at", ISO).alias("played_at"), track.alias("track"))
    lists = (plays.select("user_id", "page", item.alias("item")).groupBy("user_id", "page")
             .agg(F.array_sort(F.collect_list("item")).alias("items")))
    return lists.select(F.to_json(F.struct(
        F.col("user_id").cast("string").alias("user_id"), F.lit("AT").alias("country"),
        "items")).alias("payload"))


def _payloads(texts):
    schema = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("country", T.StringType()),
                           T.StructField("items", T.ArrayType(RECENT_ITEM))])
    return payloads.parse_payloads(texts, "payload", schema)


@query(f"""
WITH {b.PLAYS}
SELECT '1.0' AS event_version, 'recent_play' AS event_type,
       '2024-02-01T00:00:00.000000+00:00' AS generated_at, CAST(user_id AS VARCHAR) AS user_id,
       'AT' AS country, 'AT' AS market_used, strftime(played_at, '{SQL_ISO}') AS played_at,
       track_id, track_name,
       CAST(CASE WHEN duration_ms > 20 THEN floor(duration_ms) ELSE 0 END AS BIGINT)
         AS track_duration_ms,
       CASE WHEN album_id <> 'error' THEN album_id END AS album_id,
       CASE WHEN album_id <> 'error' THEN album_name END AS album_name,
       CASE WHEN album_id <> 'error' THEN '2020' END AS album_release_date,
       concat_ws(',', nullif(artist_1, ''), nullif(artist_2, '')) AS artist_ids,
       replace(track_artists, ', ', ',') AS artist_names
FROM plays""")
def play_events(spark, sf_dir):
    """All plays, out of payloads of up to 50 plays of a user's day each."""
    day = F.to_date("played_at")
    newest = W.partitionBy("user_id", day).orderBy(F.desc("played_at"), "event_id")
    place = F.row_number().over(newest) - 1
    paged = (b.plays(spark, sf_dir).withColumn("place", place).withColumn("idx", F.col("place") % RECENT_LIMIT)
             .withColumn("page", F.struct(day.alias("day"), F.floor(F.col("place") / RECENT_LIMIT).alias("n"))))
    now = F.to_timestamp_ltz(F.lit("2024-02-01T00:00:00Z"))
    events = listening.play_events(_payloads(_payload_texts(paged)), now=now)
    return (events.withColumn("artist_ids", F.array_join("artist_ids", ","))
            .withColumn("artist_names", F.array_join("artist_names", ",")))


@query(f"""
WITH {b.PLAYS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY played_at DESC, track_id) AS rn FROM (
  SELECT DISTINCT user_id, played_at, track_id, track_name, track_artists FROM plays)),
recent AS (SELECT *, rn - 1 AS idx FROM ranked WHERE rn <= 50),
stats AS (SELECT user_id, track_id, count(*) AS plays, min(idx) AS first_idx, arg_min(track_name, idx) AS name
          FROM recent WHERE track_id <> '' GROUP BY user_id, track_id),
board AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY plays DESC, first_idx, lower(name)) AS rank
          FROM stats)
SELECT CAST(user_id AS VARCHAR) AS user_id, rank, track_id, plays, CAST(first_idx AS BIGINT) AS first_idx
FROM board WHERE rank <= 10""")
def leaderboard_from_payloads(spark, sf_dir):
    """Boards over each user's last 50 plays, out of payloads that overlap by half."""
    newest = W.partitionBy("user_id").orderBy(F.desc("played_at"), "event_id")
    plays = b.plays(spark, sf_dir).withColumn("place", F.row_number().over(newest) - 1)
    half = RECENT_LIMIT // 2
    # Every play is in two payloads: the one that begins with its half, and the one before.
    runs = F.array(F.floor(F.col("place") / half), F.floor(F.col("place") / half) - 1)
    overlapping = (plays.withColumn("page", F.explode(runs))
                   .withColumn("idx", F.col("place") - F.col("page") * half))
    rows = listening.recent_plays(_payloads(_payload_texts(overlapping)))
    stats = listening.listening_stats(rows, "track_id", ["track_name"])
    return listening.leaderboard(stats, "track_name", 10).select(
        "user_id", F.col("rank").cast("bigint").alias("rank"), "track_id", "plays",
        F.col("first_idx").cast("bigint").alias("first_idx"))


@query(f"""
WITH {b.LAST_50}
SELECT user_id, count(*) AS plays, arg_min(played_at, idx) AS newest_played_at
FROM last_plays GROUP BY user_id""")
def batch_summary(spark, sf_dir):
    return listening.batch_summary(_recent(spark, sf_dir))


@query(f"WITH {b.PLAYS} SELECT user_id, played_at, track_id FROM plays")
def timeline(spark, sf_dir):
    return (listening.timeline(b.plays(spark, sf_dir), tiebreak=["event_id"])
            .select("user_id", "played_at", "track_id"))


@query(f"""
WITH {_RANKED_ARTISTS}, {_CATALOG}
SELECT artist_id, market, CAST(rank - 1 AS BIGINT) AS position, track_id, track_name, printf('%02d:%02d',
       duration_ms // 60000, (duration_ms // 1000) % 60) AS length, duration_ms // 1000 AS seconds
FROM catalog""")
def catalogue_payloads(spark, sf_dir):
    """Top tracks per artist and market as JSON payloads, flattened again."""
    placed = W.partitionBy("artist_id", "market").orderBy("position")
    entry = F.struct((F.row_number().over(placed) - 1).alias("place"), "track")
    lists = (_catalog(spark, sf_dir).select("artist_id", "market", entry.alias("entry")).groupBy("artist_id", "market")
             .agg(F.array_sort(F.collect_list(F.struct(F.col("entry.place").alias("place"), F.col("entry.track").alias("track"))))
                  .alias("entries")))
    texts = lists.select(F.to_json(F.struct("artist_id", "market", F.transform("entries", lambda e: e["track"])
                                            .alias("tracks"))).alias("payload"))
    rows = payloads.artist_top_tracks(payloads.parse_payloads(texts, "payload", ARTIST_TOP_TRACKS))
    ms = F.col("track.duration_ms")
    return rows.select("artist_id", "market", F.col("position").cast("bigint").alias("position"),
                       F.col("track.id").alias("track_id"), F.col("track.name").alias("track_name"),
                       P.ms_to_mmss(ms).alias("length"), P.seconds(ms).alias("seconds"))


@query(f"""
WITH {b.PLAYS}
SELECT event_id, track_id, track_name, CASE WHEN k % 11 = 0 THEN '' ELSE track_artists END AS artists
FROM plays WHERE k % 10 <> 9""")
def listed_artists(spark, sf_dir):
    """Raw entries with a track id, with the names of those artists that have one."""
    artists = F.transform("artists", lambda a: F.struct(
        a["id"].alias("id"), F.when(a["id"] == "", F.lit("")).otherwise(a["name"]).alias("name")))
    track = F.struct(F.when(F.col("track_id").cast("int") % 10 != 9, F.col("track_id")).alias("id"),
                     F.col("track_name").alias("name"), artists.alias("artists"))
    items = b.plays(spark, sf_dir).select("event_id", track.alias("track"))
    return payloads.listed_tracks(items).select("event_id", "track_id", "track_name", "artists")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity,
       printf('%02d:%02d', CAST(floor(l_extendedprice * 100) AS BIGINT) // 60000,
              (CAST(floor(l_extendedprice * 100) AS BIGINT) // 1000) % 60) AS length,
       CAST(floor(l_extendedprice * 100) AS BIGINT) // 1000 AS seconds
FROM lineitem""")
def duration_mmss(spark, sf_dir):
    ms = F.floor(F.col("l_extendedprice") * 100)
    return b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", P.ms_to_mmss(ms).alias("length"),
        P.seconds(ms).alias("seconds"))


@query("""
SELECT CASE WHEN l_returnflag <> 'N' THEN CAST(l_partkey AS VARCHAR) || CAST(l_orderkey AS VARCHAR) END
         AS _id, count(*) AS n FROM lineitem GROUP BY 1""")
def composite_key(spark, sf_dir):
    track = F.when(F.col("l_returnflag") != "N", F.col("l_partkey"))
    keyed = b.table(spark, sf_dir, "lineitem").select(P.composite_key(track, "l_orderkey").alias("_id"))
    return keyed.groupBy("_id").agg(F.count("*").alias("n"))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 0
                      ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS number,
       CASE WHEN event_type = 'view' THEN 'value' ELSE event_type END AS picked
FROM events""")
def scalar_fallbacks(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(
        F.get_json_object("props", "$.k"))
    document = F.struct(
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("tempo"),
        F.struct(F.lit("value").alias("tempo")).alias("audio_features"))
    return b.table(spark, sf_dir, "events").select(
        "event_id", P.int_or_zero(text).alias("number"), P.pick(document, "tempo").alias("picked"))


@query("""
SELECT event_id, CASE WHEN event_type = 'click' THEN NULL
                      ELSE round(value, 6) END AS number FROM events""")
def numeric_only(spark, sf_dir):
    # Clicks carry the value as text, which is no number.
    quoted = F.concat(F.lit('{"v": "'), F.col("value").cast("string"), F.lit('"}'))
    plain = F.concat(F.lit('{"v": '), F.col("value").cast("string"), F.lit("}"))
    text = F.when(F.col("event_type") == "click", quoted).otherwise(plain)
    return b.table(spark, sf_dir, "events").select(
        "event_id", F.round(P.numeric_or_null(text, "$.v"), 6).alias("number"))


@query(f"""
WITH {b.PLAYS}
SELECT album_id AS topic, count(*) AS messages, CAST(sum(length(track_id)) AS BIGINT) AS id_chars,
       count(*) FILTER (WHERE album_id = 'view') AS null_fields
FROM plays GROUP BY album_id""")
def topic_messages(spark, sf_dir):
    """Plays as messages, read back from their JSON text."""
    rows = b.plays(spark, sf_dir).select(
        "track_id", "album_id", F.when(F.col("album_id") != "view", F.col("user_id")).alias("user_id"))
    messages = as_messages(rows, "plays")
    back = F.from_json("value", "track_id string, album_id string, user_id bigint")
    nulls = F.col("value").contains('"user_id":null')
    return (messages.select(back.alias("m"), nulls.alias("has_null"))
            .groupBy(F.col("m.album_id").alias("topic")).agg(
                F.count("*").alias("messages"),
                F.sum(F.length("m.track_id")).alias("id_chars"),
                F.count_if("has_null").alias("null_fields")))


@query(f"""
WITH {b.PLAYS}
SELECT user_id, event_id, played_at FROM plays WHERE album_id = 'purchase'""")
def where_equal(spark, sf_dir):
    found = tables.where_equal(b.plays(spark, sf_dir), "album_id", "purchase")
    return tables.project(found, ["user_id", "event_id", "played_at"])


@query("""
WITH busy AS (SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)
SELECT user_id, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS played_at FROM events JOIN busy USING (user_id)""")
def clustered_timeline(spark, sf_dir):
    """The timeline of the user with most plays, out of plays laid out by user and time."""
    path = work_path(spark, "clustered")
    plays = b.table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").alias("played_at"))
    clustering.write_clustered(plays, path, 32)
    busy = plays.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").first()["user_id"]
    rows = clustering.read_timeline(spark, path, busy)
    return rows.withColumn("played_at", F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss"))
