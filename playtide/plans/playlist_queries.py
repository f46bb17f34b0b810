"""Queries over playlists: tracks, profiles, first choices, genre comparison, seeds."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playtide.operators import playlists as ops, tables
from playtide.operators import paging
from playtide.plans import bindings as b
from playtide.plans.registry import query
from playtide.schemas import ALBUM_PAGE, SEARCH_RESULT, USER_PLAYLISTS
from playtide.session import dealt, work_path
from playtide.sources import documents, files, payloads
from playtide.streaming import stores

_ORDER = ", ".join(b.ENTRY_ORDER)
FEATURES = ["danceability", "energy", "tempo", "duration"]


@query(f"""
SELECT playlist_id, track_id, tempo FROM (
  SELECT l_orderkey AS playlist_id, l_partkey AS track_id, l_quantity AS tempo,
         row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY {_ORDER}) AS rn
  FROM lineitem) WHERE rn = 1""")
def playlist_tracks(spark, sf_dir):
    unique = ops.first_of_each_track(b.entries(spark, sf_dir), order=b.ENTRY_ORDER)
    return unique.select("playlist_id", "track_id", "tempo")


@query("""
SELECT o_custkey AS owner_id, l_orderkey AS playlist_id, o_orderpriority AS playlist_name,
       CAST(l_partkey AS VARCHAR) AS track_id, p_name AS track_name, p_type AS album_id,
       p_brand AS album_name, CAST(l_partkey AS VARCHAR) || CAST(l_orderkey AS VARCHAR) AS _id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")
def playlist_table(spark, sf_dir):
    part = b.table(spark, sf_dir, "part")
    track = F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
                     F.struct(F.col("p_type").alias("id"), F.col("p_brand").alias("name")).alias("album"))
    items = (b.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("playlist_id"), "l_partkey")
             .join(part.select(F.col("p_partkey").alias("l_partkey"), track.alias("track")), "l_partkey")
             .join(b.playlists(spark, sf_dir), "playlist_id")
             .select("owner_id", "playlist_id", "playlist_name", "track"))
    return ops.playlist_table(items)


@query("""
SELECT o_orderpriority AS playlist_name, CAST(o_orderkey AS VARCHAR) AS _id FROM orders""")
def columns_from(spark, sf_dir):
    rows = b.playlists(spark, sf_dir).select(
        "owner_id", "playlist_name", F.col("playlist_id").cast("string").alias("_id"))
    return tables.columns_from(rows, "playlist_name")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def last_rows(spark, sf_dir):
    return tables.last_rows(b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])


# A feature of 0 stands for a missing one.
@query("""
WITH f AS (
  SELECT o_orderpriority AS playlist_name, nullif(l_discount, 0) AS danceability,
         nullif(l_tax, 0) AS energy, l_quantity AS tempo, l_extendedprice AS duration
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT playlist_name, round(avg(danceability), 6) AS danceability, round(avg(energy), 6) AS energy,
       round(avg(tempo), 6) AS tempo, round(avg(duration), 6) AS duration
FROM (SELECT playlist_name,
        CASE WHEN energy IS NOT NULL THEN danceability END AS danceability,
        CASE WHEN danceability IS NOT NULL THEN energy END AS energy,
        CASE WHEN danceability IS NOT NULL AND energy IS NOT NULL THEN tempo END AS tempo,
        CASE WHEN danceability IS NOT NULL AND energy IS NOT NULL THEN duration END AS duration
      FROM f) GROUP BY playlist_name""")
def playlist_profile(spark, sf_dir):
    entries = b.entries(spark, sf_dir).select("playlist_id", *FEATURES)
    named = entries.join(b.playlists(spark, sf_dir).select("playlist_id", "playlist_name"), "playlist_id")
    for c in ("danceability", "energy"):
        named = named.withColumn(c, F.nullif(c, F.lit(0.0)))
    profile = ops.playlist_audio_profile(named, "playlist_name", FEATURES)
    return profile.select("playlist_name", *[F.round(c, 6).alias(c) for c in FEATURES])


def _searches(spark, sf_dir):
    """Orders as search results: the priority text is the query, the position by date."""
    return b.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("query"), F.col("o_orderkey").alias("playlist_id"),
        F.struct("o_orderdate", "o_orderkey").alias("found"))


def _found(spark, sf_dir):
    """All results per query text with their positions."""
    return ops.positions(_searches(spark, sf_dir), "query", ["found"]).select("query", "position", "playlist_id")


def _genres(spark, sf_dir):
    """Genres to compare: half-texts of the priorities; some only match by a fallback, one never."""
    orders = b.table(spark, sf_dir, "orders")
    text = F.col("o_orderpriority")
    return (orders.select(F.explode(F.array(text, F.substring(text, 1, 2), F.lit("unknown"))).alias("genre"))
            .distinct())


FALLBACKS = ["{}HIGH", "{}LOW"]
FOUND = 3  # results of a search that are looked at
_PICKED = """
genres AS (SELECT DISTINCT unnest([o_orderpriority, substr(o_orderpriority, 1, 2), 'unknown']) AS genre
           FROM orders),
found AS (SELECT * FROM (
  SELECT o_orderpriority AS query, o_orderkey AS playlist_id,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS position
  FROM orders) WHERE position < 3),
terms AS (SELECT genre, genre AS query, 0 AS priority FROM genres
          UNION ALL SELECT genre, genre || 'HIGH', 1 FROM genres
          UNION ALL SELECT genre, genre || 'LOW', 2 FROM genres),
picked AS (SELECT genre, playlist_id FROM (
  SELECT genre, playlist_id, row_number() OVER (PARTITION BY genre ORDER BY priority, position) AS rn
  FROM terms JOIN found USING (query)) WHERE rn = 1)"""


@query(f"WITH {_PICKED} SELECT genre, playlist_id FROM picked")
def first_playlist_per_genre(spark, sf_dir):
    return ops.pick_playlists(_genres(spark, sf_dir), _found(spark, sf_dir), FALLBACKS, FOUND)


_FIRST = f"""
firsts AS (SELECT * FROM (
  SELECT l_orderkey AS playlist_id, l_partkey AS track_id, l_discount, l_tax, l_quantity,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER}) - 1 AS position
  FROM lineitem) WHERE position < 3)"""


@query(f"WITH {_FIRST} SELECT playlist_id, track_id, position FROM firsts")
def first_n_per_playlist(spark, sf_dir):
    first = ops.first_entries(b.entries(spark, sf_dir), 3, "playlist_id", b.ENTRY_ORDER)
    return first.select("playlist_id", "track_id", F.col("position").cast("bigint").alias("position"))


def _items(spark, sf_dir):
    """All entries of every playlist as raw items; tracks of quantity 1 have no id."""
    placed = ops.positions(b.entries(spark, sf_dir), "playlist_id", b.ENTRY_ORDER)
    track = F.struct(
        F.when(F.col("tempo") != 1, F.col("track_id").cast("string")).alias("id"),
        F.concat(F.lit("Track "), F.col("track_id").cast("string")).alias("name"),
        F.array(F.struct(F.lit("a").alias("id"), F.lit("A").alias("name"))).alias("artists"))
    return placed.select("playlist_id", "position", track.alias("track"))


_VALUES = """
features AS (SELECT CAST(p_partkey AS VARCHAR) AS track_id,
                    CASE WHEN p_size > 5 THEN p_retailprice / 1000 END AS danceability FROM part),
chosen AS (SELECT genre, track_id FROM (
  SELECT DISTINCT genre, CAST(track_id AS VARCHAR) AS track_id
  FROM picked JOIN firsts USING (playlist_id) WHERE l_quantity <> 1))"""


def _analysis(spark, sf_dir):
    return b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("track_id"),
        F.when(F.col("p_size") > 5, F.col("p_retailprice") / 1000).alias("danceability"))


@query(f"WITH {_PICKED}, {_FIRST}, {_VALUES} SELECT genre, playlist_id, track_id FROM chosen JOIN picked USING (genre)")
def first_n_per_genre(spark, sf_dir):
    tracks = ops.genre_tracks(_genres(spark, sf_dir), _found(spark, sf_dir), _items(spark, sf_dir), 3, FALLBACKS,
                              FOUND)
    return tracks.select("genre", "playlist_id", "track_id")


@query(f"""
WITH {_PICKED}, {_FIRST}, {_VALUES}
SELECT genre, round(avg(danceability), 6) AS avg_danceability, count(danceability) AS n_tracks
FROM genres LEFT JOIN chosen USING (genre) LEFT JOIN features USING (track_id) GROUP BY genre""")
def compare_genres(spark, sf_dir):
    table = ops.compare_genres(_genres(spark, sf_dir), _found(spark, sf_dir), _items(spark, sf_dir),
                               _analysis(spark, sf_dir), n=3, fallbacks=FALLBACKS, found=FOUND)
    return table.withColumn("avg_danceability", F.round("avg_danceability", 6))


@query(f"""
WITH {_PICKED}, {_FIRST}, {_VALUES}
SELECT genre, avg_danceability FROM (
  SELECT genre, round(avg(danceability), 6) AS avg_danceability
  FROM chosen JOIN features USING (track_id) GROUP BY genre) WHERE avg_danceability IS NOT NULL""")
def drop_missing(spark, sf_dir):
    table = compare_genres(spark, sf_dir).select("genre", "avg_danceability")
    return tables.drop_missing(table, ["avg_danceability"])


@query("""
SELECT p_partkey AS track_id, p_name AS name, p_retailprice AS price, CAST(NULL AS BIGINT) AS owner_id
FROM part UNION ALL
SELECT o_orderkey, NULL, o_totalprice, o_custkey FROM orders""")
def union_playlists(spark, sf_dir):
    left = b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("track_id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))
    right = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("track_id"), F.col("o_totalprice").alias("price"),
        F.col("o_custkey").alias("owner_id"))
    return tables.stack_rows([left, right])


@query("""
SELECT p_name, p_partkey, p_brand FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""")
def seed_if_empty(spark, sf_dir):
    """Seeded twice, the second time with other rows: the first seed stays."""
    path = work_path(spark, "seed")
    part = b.table(spark, sf_dir, "part").select("p_name", "p_partkey", "p_brand")
    stores.seed_if_empty(part, path, key="p_name", order=["p_partkey"])
    stores.seed_if_empty(part.withColumn("p_brand", F.lit("other")), path)
    return spark.read.parquet(path)


@query("SELECT p_name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return stores.duplicate_keys(b.table(spark, sf_dir, "part"), "p_name")


@query(f"""
SELECT playlist_id AS album_id, position, track_id, name FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS playlist_id, CAST(l_partkey AS VARCHAR) AS track_id,
         'Track ' || l_partkey AS name,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER}) - 1 AS position
  FROM lineitem)""")
def album_pages(spark, sf_dir):
    """All entries of all orders as JSON pages of three, put together again."""
    first = ops.positions(b.entries(spark, sf_dir), "playlist_id", b.ENTRY_ORDER)
    place = F.col("position").cast("bigint")
    track = F.struct("position", F.col("track_id").cast("string").alias("id"),
                     F.concat(F.lit("Track "), F.col("track_id").cast("string")).alias("name"))
    # Three tracks per page.
    pages = (first.groupBy(F.col("playlist_id").cast("string").alias("album_id"),
                           (place - place % 3).alias("offset"))
             .agg(F.array_sort(F.collect_list(track)).alias("items")))
    texts = pages.select(F.to_json(F.struct("album_id", "offset", "items")).alias("page"))
    items = payloads.paged_items(payloads.parse_payloads(texts, "page", ALBUM_PAGE))
    return items.select("album_id", "position", F.col("id").alias("track_id"), "name")


@query("""
SELECT query, CAST(position AS INTEGER) AS position, playlist_id FROM (
  SELECT o_orderpriority || ' ' || o_custkey AS query, CAST(o_orderkey AS VARCHAR) AS playlist_id,
         row_number() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS position
  FROM orders) WHERE position < 5 AND position <> 1""")
def playlist_search(spark, sf_dir):
    """The orders per customer and priority as a search result in JSON; the second one has no name."""
    text = F.concat_ws(" ", "o_orderpriority", "o_custkey")
    searches = b.table(spark, sf_dir, "orders").select(
        text.alias("q"), F.col("o_orderkey").alias("playlist_id"), F.struct("o_orderdate", "o_orderkey").alias("found"))
    placed = ops.positions(searches, "q", ["found"])
    entry = F.struct("position", F.col("playlist_id").cast("string").alias("id"),
                     F.when(F.col("position") != 1, F.lit("N")).otherwise(F.lit("")).alias("name"))
    # A result holds one customer's orders of one priority.
    results = placed.groupBy("q").agg(F.array_sort(F.collect_list(entry)).alias("items"))
    texts = results.select(F.to_json(F.struct(
        F.col("q").alias("query"), F.struct("items").alias("playlists"))).alias("result"))
    found = payloads.search_results(payloads.parse_payloads(texts, "result", SEARCH_RESULT), 5)
    return found.select("query", "position", "playlist_id")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS track_id, p_brand AS artists, p_type || ', "' || p_name || '"' AS track_genre,
       p_size AS popularity, CASE WHEN p_size > 3 THEN p_retailprice END AS tempo FROM part""")
def catalogue_csv(spark, sf_dir):
    """Parts written as a catalogue file with a row number and NaN, and read back."""
    path = work_path(spark, "catalogue")
    rows = b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("_row"), F.col("p_partkey").cast("string").alias("track_id"),
        F.col("p_brand").alias("artists"),
        F.concat("p_type", F.lit(', "'), "p_name", F.lit('"')).alias("track_genre"),
        F.col("p_size").alias("popularity"),
        F.when(F.col("p_size") > 3, F.col("p_retailprice")).otherwise(F.lit(float("nan"))).alias("tempo"))
    rows.write.option("escape", '"').csv(path, header=True)
    return files.read_catalogue(spark, path, rows.drop("_row").schema)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS playlist_id, o_orderpriority AS playlist_name,
       CAST(o_custkey AS VARCHAR) AS owner_id, '/playlists/' || o_orderkey AS href FROM orders""")
def user_playlists(spark, sf_dir):
    """Orders as JSON lists of playlists, one per customer, flattened again."""
    item = F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("name"),
        F.struct(F.col("o_custkey").cast("string").alias("id")).alias("owner"),
        F.struct(F.concat(F.lit("/playlists/"), F.col("o_orderkey").cast("string")).alias("href")).alias("tracks"))
    lists = (b.table(spark, sf_dir, "orders").select("o_custkey", item.alias("item")).groupBy("o_custkey")
             .agg(F.collect_list("item").alias("items")))
    texts = lists.select(F.to_json(F.struct("items")).alias("payload"))
    return payloads.user_playlists(payloads.parse_payloads(texts, "payload", USER_PLAYLISTS))


@query("""
WITH f AS (
  SELECT o_orderpriority AS playlist_name, CASE WHEN p_size > 5 THEN p_size / 50 END AS danceability,
         CASE WHEN p_size % 7 <> 0 THEN p_retailprice / 1000 END AS energy
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
c AS (SELECT playlist_name, CASE WHEN energy IS NOT NULL THEN danceability END AS danceability,
             CASE WHEN danceability IS NOT NULL THEN energy END AS energy FROM f)
SELECT playlist_name, round(avg(danceability), 6) AS danceability, round(avg(energy), 6) AS energy
FROM c GROUP BY playlist_name""")
def analysis_profile(spark, sf_dir):
    """Playlist entries joined with analysis documents: one feature at the top, one nested, some no number."""
    size, price = F.col("p_size"), F.col("p_retailprice")
    document = F.struct(
        F.when(size > 5, size / 50).alias("danceability"),
        F.struct(F.when(size % 7 != 0, (price / 1000).cast("string")).alias("text"),
                 F.when(size % 7 != 0, price / 1000).alias("energy")).alias("audio_features"))
    texts = b.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("track_id"),
                                                  F.to_json(document).alias("analysis"))
    features = payloads.analysis_features(texts, fields=["danceability", "energy"])
    entries = b.entries(spark, sf_dir).select("playlist_id", "track_id").join(features, "track_id", "left")
    named = entries.join(b.playlists(spark, sf_dir).select("playlist_id", "playlist_name"), "playlist_id")
    profile = ops.playlist_audio_profile(named, "playlist_name", ["danceability", "energy"])
    return profile.select("playlist_name", *[F.round(c, 6).alias(c) for c in ("danceability", "energy")])


@query("""
SELECT genre, CAST(place AS INTEGER) AS place, count(o_orderkey) AS n
FROM (VALUES ('5-LOW', 0), ('1-URGENT', 1), ('none', 2)) AS g(genre, place)
LEFT JOIN orders ON o_orderpriority = genre GROUP BY genre, place""")
def genre_list(spark, sf_dir):
    """The driving genres in their order, with the number of playlists of that name."""
    genres = ops.genre_list(spark, ["5-LOW", "1-URGENT", "none"])
    counts = tables.value_counts(b.table(spark, sf_dir, "orders"), "o_orderpriority")
    return genres.join(counts, F.col("genre") == F.col("o_orderpriority"), "left").select(
        "genre", "place", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@query("SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, o_totalprice FROM orders")
def record_files(spark, sf_dir):
    """Orders written as records with nulls and read back."""
    path = work_path(spark, "records")
    rows = b.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), "o_totalprice")
    files.write_records(rows, path)
    return files.read_records(spark, path, rows.schema, multi_line=False)


@query("""
SELECT CAST(row_number() OVER (ORDER BY p_type) - 1 AS BIGINT) AS row_id, p_type, round(avg(p_size), 6) AS p_size
FROM part GROUP BY p_type""")
def column_json(spark, sf_dir):
    """Means per genre written column by column, a document per run of rows, and read back."""
    path = work_path(spark, "columns")
    means = tables.group_means(b.table(spark, sf_dir, "part"), ["p_type"], ["p_size"])
    files.write_column_json(tables.number_rows(means, ["p_type"], "row_id"), path, "row_id")
    table = files.read_column_json(spark, path, {"p_type": "string", "p_size": "double"})
    return table.withColumn("p_size", F.round("p_size", 6))


def _pages(spark, sf_dir):
    """Pages per part: their places and sizes follow from the order lines, so some are missing, doubled or overlap."""
    rows = b.table(spark, sf_dir, "lineitem")
    size = F.when(F.col("l_quantity") % 5 == 0, 12).when(F.col("l_quantity") % 7 == 0, 0).otherwise(10)
    return rows.select(
        F.col("l_partkey").alias("album_id"), ((F.col("l_linenumber") - 1) * 10).alias("offset"),
        F.array_repeat(F.lit("track"), size).alias("items"),
        F.when(F.col("l_partkey") % 4 > 0, 30 + 5 * (F.col("l_partkey") % 8)).alias("total"))


@query("""
WITH pages AS (
  SELECT l_partkey AS album_id, (l_linenumber - 1) * 10 AS start,
         CASE WHEN l_quantity % 5 = 0 THEN 12 WHEN l_quantity % 7 = 0 THEN 0 ELSE 10 END AS size,
         CASE WHEN l_partkey % 4 > 0 THEN 30 + 5 * (l_partkey % 8) END AS total FROM lineitem),
known AS (SELECT album_id, start, size, count(*) AS copies FROM pages GROUP BY ALL),
lengths AS (SELECT album_id, coalesce(max(total), max(start + size)) AS length FROM pages GROUP BY album_id),
places AS (SELECT album_id, length, unnest(range(0, greatest(length, 200))) AS pos FROM lengths),
covered AS (
  SELECT p.album_id, pos, any_value(length) AS length, count(k.start) AS n
  FROM places p LEFT JOIN known k ON k.album_id = p.album_id AND k.start <= pos AND pos < k.start + k.size GROUP BY 1, 2),
wrong AS (
  SELECT album_id, pos, n, pos - row_number() OVER (PARTITION BY album_id, n ORDER BY pos) AS run
  FROM covered WHERE n > 1 OR (n = 0 AND pos < length))
SELECT album_id, CASE n WHEN 0 THEN 'gap' ELSE 'overlap' END AS kind, min(pos) AS start, max(pos) + 1 AS stop, n AS copies
FROM wrong GROUP BY album_id, n, run
UNION ALL SELECT album_id, 'repeat', start, start + size, copies FROM known WHERE copies > 1""")
def page_gaps(spark, sf_dir):
    return paging.page_gaps(_pages(spark, sf_dir))


@query("SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, o_totalprice FROM orders")
def array_documents(spark, sf_dir):
    """Orders as documents of one array per priority, written line by line, and read back by byte ranges."""
    path = work_path(spark, "arrays")
    text = F.to_json(F.struct("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), "o_totalprice"),
                     {"ignoreNullFields": "false"})
    orders = b.table(spark, sf_dir, "orders")
    rows = orders.select((F.col("o_orderkey") % 50).alias("part"), "o_orderpriority", "o_orderkey", text.alias("value"))
    # Each line says whether a document begins or ends there, so that no task holds a document.
    document = W.partitionBy("part", "o_orderpriority").orderBy("o_orderkey")
    lines = dealt(rows, orders.count(), "part", "o_orderpriority").select(
        F.concat(F.when(F.lag(F.lit(1)).over(document).isNull(), F.lit("[")).otherwise(F.lit("")), "value",
                 F.when(F.lead(F.lit(1)).over(document).isNull(), F.lit("]\n")).otherwise(F.lit(","))).alias("value"))
    lines.write.text(path)
    return documents.read_array_records(spark, path, "o_orderkey bigint, o_orderpriority string, o_totalprice double")
