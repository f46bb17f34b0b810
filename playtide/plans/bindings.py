"""The given tables in the roles of listening data, and the same roles as SQL.

``events`` are plays, ``lineitem`` with ``part`` is the track catalogue, ``orders``
are playlists and ``lineitem`` their entries, ``customer`` to ``region`` gives places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Order of entries within a playlist; line numbers alone repeat.
ENTRY_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_shipdate"]
FEATURES = ["duration", "danceability", "energy", "tempo"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays with one or two credited artists; some have an empty id."""
    k = F.get_json_object("props", "$.k")
    number = F.col("track_id").cast("int")

    def artist(modulus: int):
        n = (number % modulus).cast("string")
        return F.struct(
            F.when(number % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("a"), n)).alias("id"),
            F.concat(F.lit("Artist "), n).alias("name"))

    # Any expression of these columns reads only what it uses of the scan.
    return (table(spark, sf_dir, "events")
            .select("user_id", F.col("ts").alias("played_at"), "event_id", k.alias("track_id"),
                    F.col("event_type").alias("album_id"), F.col("value").alias("duration_ms"))
            .withColumn("artists", F.when(number % 3 == 0, F.array(artist(10), artist(7)))
                        .otherwise(F.array(artist(10))))
            .withColumn("track_name", F.concat(F.lit("Track "), F.col("track_id")))
            .withColumn("album_name", F.upper("album_id"))
            .withColumn("track_artists", F.concat_ws(
                ", ", F.concat(F.lit("Artist "), (number % 10).cast("string")),
                F.when(number % 3 == 0, F.concat(F.lit("Artist "), (number % 7).cast("string")))))
            .withColumn("album_artists", F.concat(F.lit("Various "), F.col("album_id"))))


PLAYS = """
plays AS (
  SELECT user_id, played_at, event_id, track_id, album_id, duration_ms, k,
         'Track ' || track_id AS track_name, upper(album_id) AS album_name,
         'Various ' || album_id AS album_artists,
         'Artist ' || (k % 10) || CASE WHEN k % 3 = 0 THEN ', Artist ' || (k % 7) ELSE '' END
           AS track_artists,
         CASE WHEN k % 11 = 0 THEN '' ELSE 'a' || (k % 10) END AS artist_1,
         CASE WHEN k % 3 = 0 THEN CASE WHEN k % 11 = 0 THEN '' ELSE 'a' || (k % 7) END END
           AS artist_2
  FROM (SELECT user_id, ts AS played_at, event_id, json_extract_string(props, '$.k') AS track_id,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type AS album_id,
               value AS duration_ms FROM events))"""

LAST_50 = PLAYS + """,
last_plays AS (
  SELECT *, rn - 1 AS idx FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY played_at DESC, event_id) AS rn
    FROM plays) WHERE rn <= 50)"""

CREDITS = LAST_50 + """,
credits AS (
  SELECT user_id, idx, 0 AS pos, artist_1 AS artist_id FROM last_plays WHERE artist_1 <> ''
  UNION ALL
  SELECT user_id, idx, 1, artist_2 FROM last_plays WHERE artist_2 <> '')"""


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows: features of ``lineitem`` with genre, artist and popularity of the part."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("track_id"), F.col("p_type").alias("genre"),
        F.col("p_brand").alias("artists"), F.col("p_size").alias("popularity"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("track_id"), F.col("l_extendedprice").alias("duration"),
        F.col("l_discount").alias("danceability"), F.col("l_tax").alias("energy"),
        F.col("l_quantity").alias("tempo"))
    return rows.join(part, "track_id")


TRACKS = """
tracks AS (
  SELECT l_partkey AS track_id, l_extendedprice AS duration, l_discount AS danceability,
         l_tax AS energy, l_quantity AS tempo, p_type AS genre, p_brand AS artists,
         p_size AS popularity
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Playlist entries with their features."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("playlist_id"), F.col("l_partkey").alias("track_id"),
        F.col("l_discount").alias("danceability"), F.col("l_tax").alias("energy"),
        F.col("l_quantity").alias("tempo"), F.col("l_extendedprice").alias("duration"),
        *[F.col(c) for c in ENTRY_ORDER])


def playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("playlist_id"), F.col("o_custkey").alias("owner_id"),
        F.col("o_orderpriority").alias("playlist_name"), F.col("o_orderdate").alias("created"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with their country and region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (table(spark, sf_dir, "customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"),
                    F.col("n_name").alias("country"), F.col("r_name").alias("region")))


USERS = """
users AS (
  SELECT c_custkey AS user_id, n_name AS country, r_name AS region FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
