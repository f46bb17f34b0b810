"""Queries for listening digests, playlist matching and trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from playtide.operators import catalog, stories, tables
from playtide.plans import bindings as b
from playtide.plans.registry import query
from playtide.session import dealt


def _round(df, *columns, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


@query("""
WITH t AS (
  SELECT l_orderkey AS album_id, l_linenumber AS position, l_partkey AS track_id,
         CAST(l_quantity * 7321 AS BIGINT) AS ms
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_custkey IN (SELECT user_id FROM events)),
a AS (SELECT album_id, CAST(sum(ms) AS BIGINT) AS total, count(*) AS n FROM t GROUP BY album_id)
SELECT album_id, position, track_id, printf('%02d:%02d', ms // 60000, (ms // 1000) % 60) AS length,
       printf('%02d:%02d', total // 60000, (total // 1000) % 60) AS album_length, n AS album_tracks
FROM t JOIN a USING (album_id)""")
def album_track_list(spark, sf_dir):
    orders, events, lines = (b.table(spark, sf_dir, name) for name in ("orders", "events", "lineitem"))
    n_orders, n_events, n_lines = orders.count(), events.count(), lines.count()
    users = dealt(events.select(F.col("user_id").alias("o_custkey")), max(n_orders, n_events), "o_custkey").distinct()
    heard = dealt(orders.select("o_custkey", "o_orderkey"), max(n_orders, n_events), "o_custkey").join(
        users, "o_custkey", "left_semi")
    tracks = lines.select(
        F.col("l_orderkey").alias("album_id"), F.col("l_linenumber").alias("position"),
        F.col("l_partkey").alias("track_id"),
        (F.col("l_quantity") * 7321).cast("bigint").alias("duration_ms"))
    albums = dealt(heard.select(F.col("o_orderkey").alias("album_id")), max(n_orders, n_lines), "album_id")
    tracks = dealt(tracks, max(n_orders, n_lines), "album_id").join(albums, "album_id")
    listed = catalog.album_track_list(tracks, keep=["position", "track_id"])
    return listed.select("album_id", "position", "track_id", "length", "album_length", "album_tracks")


@query("""
SELECT l_orderkey AS playlist_id, round(avg(l_discount), 6) AS danceability, round(avg(l_tax), 6) AS energy,
       round((avg(l_discount) + avg(l_tax)) / 2, 6) AS score
FROM lineitem GROUP BY l_orderkey""")
def party_fitness(spark, sf_dir):
    return _round(stories.party_fitness(b.entries(spark, sf_dir)), "danceability", "energy", "score")


@query(f"""
WITH {b.TRACKS},
q AS (SELECT genre, quantile_cont(popularity, 0.9) AS least FROM tracks GROUP BY genre)
SELECT genre, popularity >= least AS successful, count(*) AS tracks, round(avg(danceability), 6) AS danceability,
       round(avg(energy), 6) AS energy, round(avg(tempo), 6) AS tempo
FROM tracks JOIN q USING (genre) GROUP BY 1, 2""")
def success_profile(spark, sf_dir):
    features = ["danceability", "energy", "tempo"]
    return _round(stories.success_profile(b.tracks(spark, sf_dir), features), *features)


# Parts as tracks with a key, a mode and a tempo.
_KEYED = """
k AS (SELECT CAST(p_partkey AS VARCHAR) AS track_id, p_type AS genre, p_size % 12 AS key, p_partkey % 2 AS mode,
             100 + p_size / 5.0 AS tempo, p_retailprice / 1000 AS energy, p_size / 50.0 AS valence FROM part),
coded AS (SELECT *, ((CASE WHEN mode = 1 THEN key ELSE (key + 3) % 12 END) * 7 + 7) % 12 + 1 AS place,
                 CASE WHEN mode = 1 THEN 'B' ELSE 'A' END AS letter FROM k)"""


def _keyed(spark, sf_dir):
    size = F.col("p_size")
    return b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("track_id"), F.col("p_type").alias("genre"),
        (size % 12).alias("key"), (F.col("p_partkey") % 2).cast("int").alias("mode"),
        (100 + size / 5.0).alias("tempo"), (F.col("p_retailprice") / 1000).alias("energy"),
        (size / 50.0).alias("valence"))


@query(f"""
WITH {_KEYED},
tops AS (SELECT genre, place, letter FROM (
  SELECT genre, place, letter, row_number() OVER (PARTITION BY genre ORDER BY count(*) DESC, key, mode) AS rn
  FROM coded GROUP BY genre, key, mode, place, letter) WHERE rn = 1),
styles AS (SELECT genre AS style, place, letter, tempo, energy, valence FROM tops JOIN (
  SELECT genre, avg(tempo) AS tempo, avg(energy) AS energy, avg(valence) AS valence FROM k GROUP BY genre)
  USING (genre)),
pairs AS (SELECT style AS from_style, lead(style) OVER (ORDER BY style) AS to_style FROM styles),
fits AS (
  SELECT a.style AS from_style, z.style AS to_style, track_id,
         round(abs(c.energy - a.energy) + abs(c.energy - z.energy)
               + abs(c.valence - a.valence) + abs(c.valence - z.valence), 6) AS distance
  FROM pairs JOIN styles a ON from_style = a.style JOIN styles z ON to_style = z.style JOIN coded c
    ON c.tempo BETWEEN a.tempo * (1 - 0.06) AND a.tempo * (1 + 0.06)
   AND c.tempo BETWEEN z.tempo * (1 - 0.06) AND z.tempo * (1 + 0.06)
   AND ((c.letter = a.letter AND (c.place - a.place + 12) % 12 IN (0, 1, 11)) OR (c.letter <> a.letter AND c.place = a.place))
   AND ((c.letter = z.letter AND (c.place - z.place + 12) % 12 IN (0, 1, 11)) OR (c.letter <> z.letter AND c.place = z.place)))
SELECT from_style, to_style, track_id, distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY from_style, to_style ORDER BY distance, track_id) AS rank FROM fits)
WHERE rank <= 5""")
def bridge_tracks(spark, sf_dir):
    features = ["energy", "valence"]
    tracks = _keyed(spark, sf_dir)
    styles = stories.style_profiles(tracks, features)
    # From each genre to the next one by name.
    places = tables.number_rows(tracks.select("genre").distinct(), ["genre"], "place")
    following = places.select(F.col("genre").alias("to_style"), (F.col("place") - 1).alias("place"))
    pairs = places.withColumnRenamed("genre", "from_style").join(following, "place").drop("place")
    found = stories.bridge_tracks(tracks, styles, pairs, features)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query("""
SELECT user_id, CAST(date_trunc('month', ts) AS DATE) AS month, round(sum(value) / 3600000, 9) AS hours,
       count(*) AS plays
FROM events GROUP BY 1, 2""")
def hours_per_month(spark, sf_dir):
    return _round(stories.hours_per_month(b.plays(spark, sf_dir)), "hours", digits=9)


@query("""
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS plays,
       round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY 1""")
def listening_hours(spark, sf_dir):
    return _round(stories.listening_hours(b.plays(spark, sf_dir)), "share")


@query(f"""
WITH {b.PLAYS}, {b.USERS}
SELECT country, track_id, count(*) AS plays FROM plays JOIN users USING (user_id) GROUP BY 1, 2""")
def plays_by_country(spark, sf_dir):
    return stories.plays_by_place(b.plays(spark, sf_dir), b.users(spark, sf_dir), "country", "track_id")


def _top_sql(place: str, item: str, n: int) -> str:
    return f"""
WITH {b.PLAYS}, {b.USERS},
c AS (SELECT {place}, {item}, count(*) AS plays FROM plays JOIN users USING (user_id) GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {place} ORDER BY plays DESC, {item}) AS rank FROM c)
WHERE rank <= {n}"""


def _top(spark, sf_dir, place, item, n):
    top = stories.top_by_place(b.plays(spark, sf_dir), b.users(spark, sf_dir), place, item, n)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query(_top_sql("region", "album_id", 2))
def top_albums_by_region(spark, sf_dir):
    return _top(spark, sf_dir, "region", "album_id", 2)


@query(_top_sql("country", "track_id", 10))
def top_tracks_by_country(spark, sf_dir):
    return _top(spark, sf_dir, "country", "track_id", 10)


@query("""
SELECT l_partkey AS track_id, count(DISTINCT l_orderkey) AS playlists FROM lineitem GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 20""")
def most_playlisted(spark, sf_dir):
    return stories.most_playlisted(b.entries(spark, sf_dir), 20)


@query("""
SELECT genre, rank, track_id, popularity FROM (
  SELECT p_type AS genre, p_partkey AS track_id, p_size AS popularity,
         row_number() OVER (PARTITION BY p_type ORDER BY p_size DESC, p_partkey) AS rank FROM part)
WHERE rank <= 10""")
def top_tracks_of_genres(spark, sf_dir):
    tracks = b.table(spark, sf_dir, "part").select(
        F.col("p_type").alias("genre"), F.col("p_partkey").alias("track_id"), F.col("p_size").alias("popularity"))
    top = stories.top_tracks_of_genres(tracks, 10)
    return top.select("genre", F.col("rank").cast("bigint").alias("rank"), "track_id", "popularity")


@query(f"""
WITH {b.PLAYS}, d AS (SELECT track_id, CAST(played_at AS DATE) AS day, count(*) AS plays FROM plays GROUP BY 1, 2)
SELECT track_id, day, plays, round(sum(plays) OVER (PARTITION BY track_id ORDER BY day
         RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) / 7, 6) AS moving_average FROM d""")
def daily_plays(spark, sf_dir):
    return _round(stories.daily_plays(b.plays(spark, sf_dir), "track_id"), "moving_average")


def _user_genres(spark, sf_dir):
    """Genres (brands) per customer with their number of order lines."""
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    part = b.table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("genre"))
    return (lines.join(part, lines.l_partkey == part.p_partkey)
            .join(orders, lines.l_orderkey == orders.o_orderkey)
            .groupBy("user_id", "genre").agg(F.count("*").alias("plays")))


def _friends(spark, sf_dir):
    """Customers with neighbouring keys are friends."""
    customer = b.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    pairs = customer.withColumn("friend_id", F.col("user_id") + 1)
    return pairs.join(customer.withColumnRenamed("user_id", "friend_id"), "friend_id", "left_semi")


_FRIENDS = """
g AS (SELECT o_custkey AS user_id, p_brand AS genre, count(*) AS plays FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
f AS (SELECT c_custkey AS user_id, c_custkey + 1 AS friend_id FROM customer
      WHERE c_custkey + 1 IN (SELECT c_custkey FROM customer))"""


@query(f"""
WITH {_FRIENDS},
u AS (SELECT user_id, friend_id, genre, 1 AS mine, 0 AS theirs FROM f JOIN g USING (user_id)
      UNION ALL SELECT f.user_id, friend_id, genre, 0, 1 FROM f JOIN g ON g.user_id = friend_id),
s AS (SELECT user_id, friend_id, genre, max(mine) + max(theirs) AS sides FROM u GROUP BY 1, 2, 3)
SELECT user_id, friend_id, count(*) FILTER (WHERE sides = 2) AS common_genres,
       round(count(*) FILTER (WHERE sides = 2) / count(*), 6) AS similarity
FROM s GROUP BY 1, 2""")
def friend_match(spark, sf_dir):
    return _round(stories.friend_match(_user_genres(spark, sf_dir), _friends(spark, sf_dir)), "similarity")


@query(f"""
WITH {_FRIENDS},
h AS (SELECT *, plays / sum(plays) OVER (PARTITION BY user_id) AS share FROM g)
SELECT f.user_id, friend_id, genre, round(share, 6) AS share FROM f JOIN h ON h.user_id = friend_id
WHERE share >= 0.05 AND NOT EXISTS (SELECT 1 FROM g WHERE g.user_id = f.user_id AND g.genre = h.genre)""")
def blind_spots(spark, sf_dir):
    return _round(stories.blind_spots(_user_genres(spark, sf_dir), _friends(spark, sf_dir)), "share")


@query(f"""
WITH {b.PLAYS},
p AS (SELECT user_id, played_at, track_id AS artist_id, album_id, duration_ms,
             CAST(date_trunc('week', played_at) AS DATE) AS week FROM plays),
t AS (SELECT user_id, week, round(sum(duration_ms) / 3600000, 9) AS hours, count(*) AS plays FROM p GROUP BY 1, 2),
a AS (SELECT user_id, week, count(*) AS new_artists FROM (
        SELECT user_id, artist_id, min(week) AS week FROM p GROUP BY 1, 2) GROUP BY 1, 2),
l AS (SELECT user_id, week, count(*) AS new_albums FROM (
        SELECT user_id, album_id, min(week) AS week FROM p GROUP BY 1, 2) GROUP BY 1, 2),
b AS (SELECT user_id, week, album_id AS top_album FROM (
        SELECT user_id, week, album_id, row_number() OVER (PARTITION BY user_id, week
               ORDER BY count(*) DESC, album_id) AS rn FROM p GROUP BY 1, 2, 3) WHERE rn = 1)
SELECT user_id, week, hours, plays, coalesce(new_artists, 0) AS new_artists,
       coalesce(new_albums, 0) AS new_albums, top_album
FROM t LEFT JOIN a USING (user_id, week) LEFT JOIN l USING (user_id, week) LEFT JOIN b USING (user_id, week)""")
def weekly_digest(spark, sf_dir):
    plays = b.plays(spark, sf_dir).withColumn("artist_id", F.col("track_id"))
    return _round(stories.weekly_digest(plays), "hours", digits=9)


@query("""
WITH c AS (SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
                  event_type AS genre, count(*) AS plays FROM events GROUP BY 1, 2, 3, 4),
s AS (SELECT user_id, week, weekday, genre,
             plays / sum(plays) OVER (PARTITION BY user_id, week, weekday) AS share FROM c),
e AS (SELECT user_id, week, weekday, genre, share, 0.0 AS previous FROM s
      UNION ALL SELECT user_id, CAST(week + INTERVAL 7 DAY AS DATE), weekday, genre, 0.0, share FROM s)
SELECT user_id, week, weekday, genre, round(max(share), 6) AS share,
       round(max(share) - max(previous), 6) AS change
FROM e WHERE week <= (SELECT max(week) FROM c) GROUP BY 1, 2, 3, 4""")
def genre_drift(spark, sf_dir):
    plays = b.plays(spark, sf_dir).withColumn("genre", F.col("album_id"))
    return _round(stories.genre_drift(plays), "share", "change")


@query(f"""
WITH {b.TRACKS} SELECT track_id, energy, tempo, duration FROM tracks WHERE energy >= 0.07
ORDER BY energy DESC, track_id, tempo, duration LIMIT 50""")
def high_energy(spark, sf_dir):
    top = stories.high_energy(b.tracks(spark, sf_dir), 0.07, 50, ["track_id", "tempo", "duration"])
    return top.select("track_id", "energy", "tempo", "duration")


@query("""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS tracks,
       round(avg(l_discount), 6) AS danceability, round(avg(l_tax), 6) AS energy,
       round(avg(l_quantity), 6) AS tempo FROM lineitem GROUP BY 1""")
def release_trends(spark, sf_dir):
    features = ["danceability", "energy", "tempo"]
    return _round(stories.release_trends(b.entries(spark, sf_dir), "l_shipdate", features), *features)


@query(f"""
WITH {b.PLAYS},
a AS (SELECT artist_1 AS id FROM plays WHERE artist_1 <> '' UNION SELECT artist_2 FROM plays WHERE artist_2 <> '')
SELECT 'artist' AS kind, id, 'Artist ' || substr(id, 2) AS name FROM a
UNION ALL SELECT 'album', album_id, upper(album_id) FROM plays GROUP BY album_id
UNION ALL SELECT 'track', track_id, track_name || ' / ' || arg_max(album_id, (played_at, album_id))
  FROM plays GROUP BY track_id, track_name
UNION ALL SELECT 'plays', 'all', CAST(count(*) AS VARCHAR) FROM plays""")
def star_schema(spark, sf_dir):
    star = stories.star_schema(b.plays(spark, sf_dir))
    artists = star["dim_artists"].select(F.lit("artist").alias("kind"), F.col("artist_id").alias("id"),
                                         F.col("artist_name").alias("name"))
    albums = star["dim_albums"].select(F.lit("album"), "album_id", "album_name")
    tracks = star["dim_tracks"].select(F.lit("track"), "track_id",
                                       F.concat_ws(" / ", "track_name", "album_id"))
    facts = star["fact_plays"].agg(F.count("*").cast("string").alias("name")).select(
        F.lit("plays"), F.lit("all"), "name")
    return artists.union(albums).union(tracks).union(facts)


@query(f"""
WITH {b.PLAYS}
SELECT user_id, strftime(played_at, '%Y-%m-%dT%H:%M:%S') AS played_at, track_id, album_id,
       CASE WHEN k % 3 = 0 THEN artist_1 || ',' || artist_2 ELSE artist_1 END AS artist_ids, duration_ms FROM plays""")
def star_facts(spark, sf_dir):
    facts = stories.star_schema(b.plays(spark, sf_dir))["fact_plays"]
    return facts.select("user_id", F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss").alias("played_at"), "track_id",
                        "album_id", F.array_join("artist_ids", ",").alias("artist_ids"), "duration_ms")
