"""Listening digests, playlist matching and trend tables for users, DJs and labels.

All of them count or average per narrow key first, so that what is joined or
ranked afterwards is already reduced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playtide.functions import camelot_code
from playtide.operators.catalog import top_per_group
from playtide.operators.quantiles import exact_quantiles
from playtide.operators.tables import group_means, top_groups
from playtide.session import cut

MS_PER_HOUR = 3_600_000


def hours_per_month(plays: DataFrame, duration: str = "duration_ms") -> DataFrame:
    """Hours streamed per user and month."""
    month = F.to_date(F.date_trunc("month", "played_at")).alias("month")
    return (plays.groupBy("user_id", month)
            .agg((F.sum(duration) / MS_PER_HOUR).alias("hours"), F.count("*").alias("plays")))


def listening_hours(plays: DataFrame) -> DataFrame:
    """Plays per hour of the day and their share of all plays."""
    hours = plays.groupBy(F.hour("played_at").alias("hour")).agg(F.count("*").alias("plays"))
    # 24 rows at most, so the total needs no grouping key.
    total = F.sum("plays").over(W.partitionBy(F.lit(1)))
    return hours.withColumn("share", F.col("plays") / total)


def plays_by_place(plays: DataFrame, users: DataFrame, place: str, item: str) -> DataFrame:
    """Plays per place and item. Counted per user and item before users are looked up."""
    counts = plays.groupBy("user_id", item).agg(F.count("*").alias("plays"))
    return (counts.join(users.select("user_id", place), "user_id")
            .groupBy(place, item).agg(F.sum("plays").alias("plays")))


def top_by_place(plays: DataFrame, users: DataFrame, place: str, item: str, n: int) -> DataFrame:
    """The ``n`` most played items per place."""
    return top_per_group(plays_by_place(plays, users, place, item), [place],
                         [F.desc("plays"), item], n)


def most_playlisted(entries: DataFrame, n: int, track: str = "track_id",
                    playlist: str = "playlist_id") -> DataFrame:
    """The tracks in the largest number of different playlists."""
    spread = entries.groupBy(track).agg(F.count_distinct(playlist).alias("playlists"))
    return top_groups(spread, "playlists", n, track)


def top_tracks_of_genres(tracks: DataFrame, n: int, tiebreak: Sequence[str] = ("track_id",)) -> DataFrame:
    """The ``n`` most popular tracks per genre."""
    return top_per_group(tracks, ["genre"], [F.desc_nulls_last("popularity"), *tiebreak], n)


def party_fitness(entries: DataFrame, playlist: str = "playlist_id") -> DataFrame:
    """Mean danceability and energy per playlist, and the mean of both as score."""
    means = group_means(entries, [playlist], ["danceability", "energy"])
    return means.withColumn("score", (F.col("danceability") + F.col("energy")) / 2)


def high_energy(tracks: DataFrame, threshold: float, n: int,
                tiebreak: Sequence[str] = ("track_id",)) -> DataFrame:
    """The ``n`` tracks with most energy from ``threshold`` up."""
    return (tracks.where(F.col("energy") >= threshold)
            .orderBy(F.desc("energy"), *tiebreak).limit(n))


def success_profile(tracks: DataFrame, features: Sequence[str], top_share: float = 0.1) -> DataFrame:
    """Mean features of each genre's most popular tracks next to those of the rest.

    A track is successful from the genre's exact ``1 - top_share`` quantile of popularity up.
    """
    limits = exact_quantiles(tracks, ["genre"], ["popularity"], [1 - top_share]).select(
        "genre", F.col("value").alias("limit"))
    tagged = tracks.join(cut(limits), "genre").withColumn(
        "successful", F.col("popularity") >= F.col("limit"))
    return (tagged.where(F.col("successful").isNotNull()).groupBy("genre", "successful")
            .agg(F.count("*").alias("tracks"), *[F.avg(c).alias(c) for c in features]))


def release_trends(tracks: DataFrame, released: str, features: Sequence[str]) -> DataFrame:
    """Mean features per month of release."""
    month = F.to_date(F.date_trunc("month", released)).alias("month")
    return tracks.groupBy(month).agg(F.count("*").alias("tracks"),
                                     *[F.avg(c).alias(c) for c in features])


def daily_plays(plays: DataFrame, item: str, days: int = 7) -> DataFrame:
    """Plays per item and day and their mean over the last ``days`` calendar days.

    Days without plays count as 0. The window runs over day counts, not plays.
    """
    counts = plays.groupBy(item, F.to_date("played_at").alias("day")).agg(F.count("*").alias("plays"))
    span = W.partitionBy(item).orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return counts.withColumn("moving_average", F.sum("plays").over(span) / days)


def friend_match(genres: DataFrame, friends: DataFrame) -> DataFrame:
    """Common genres and Jaccard similarity of the genre sets per pair of friends.

    ``genres`` has one row per user and genre, ``friends`` one per ``user_id, friend_id``.
    Both ends bring their genres along the friendship, so no pair of users is formed
    that is not in ``friends``.
    """
    mine = friends.join(genres.select("user_id", "genre"), "user_id").withColumn("side", F.lit(1))
    theirs = friends.join(genres.select(F.col("user_id").alias("friend_id"), "genre"), "friend_id")
    both = (mine.unionByName(theirs.withColumn("side", F.lit(2)))
            .groupBy("user_id", "friend_id", "genre")
            .agg(F.sum_distinct("side").alias("sides")))
    return both.groupBy("user_id", "friend_id").agg(
        F.count_if(F.col("sides") == 3).alias("common_genres"),
        (F.count_if(F.col("sides") == 3) / F.count("*")).alias("similarity"))


def blind_spots(genres: DataFrame, friends: DataFrame, least_share: float = 0.05) -> DataFrame:
    """Genres a friend plays a lot and the user not at all. ``genres`` carries ``plays``."""
    total = F.sum("plays").over(W.partitionBy("user_id"))
    heavy = (genres.withColumn("share", F.col("plays") / total)
             .where(F.col("share") >= least_share)
             .select(F.col("user_id").alias("friend_id"), "genre", "share"))
    return (friends.join(heavy, "friend_id")
            .join(genres.select("user_id", "genre"), ["user_id", "genre"], "left_anti"))


def _week(c: str = "played_at") -> Column:
    return F.to_date(F.date_trunc("week", c))


def weekly_digest(plays: DataFrame, duration: str = "duration_ms") -> DataFrame:
    """Per user and Monday week: hours, plays, newly heard artists and albums, top album.

    Two aggregations over the plays: totals roll up from counts per album, and artists
    and albums share the search for their first play.
    """
    per_album = plays.groupBy("user_id", _week().alias("week"), "album_id").agg(
        F.sum(duration).alias("duration"), F.count("*").alias("n"))
    place = F.when(F.col("album_id").isNotNull(), F.struct(-F.col("n"), F.col("album_id")))
    totals = per_album.groupBy("user_id", "week").agg(
        (F.sum("duration") / MS_PER_HOUR).alias("hours"), F.sum("n").alias("plays"),
        F.min_by("album_id", place).alias("top_album"))
    items = F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(f"{kind}_id").cast("string").alias("item"))
        for kind in ("artist", "album")]))
    firsts = (plays.select("user_id", "played_at", items).where(F.col("item").isNotNull())
              .groupBy("user_id", "kind", "item").agg(F.min("played_at").alias("first")))
    heard = firsts.groupBy("user_id", _week("first").alias("week")).agg(*[
        F.count_if(F.col("kind") == kind).alias(f"new_{kind}s") for kind in ("artist", "album")])
    return (totals.join(heard, ["user_id", "week"], "left")
            .na.fill(0, ["new_artists", "new_albums"]))


def genre_drift(plays: DataFrame, genre: str = "genre") -> DataFrame:
    """Share of each genre per user and weekday, and its change from the week before.

    A genre that is gone is listed with share 0 in the week it goes missing, up to
    the last week in the data.
    """
    day = F.weekday("played_at").alias("weekday")
    counts = (plays.where(F.col(genre).isNotNull())
              .groupBy("user_id", _week().alias("week"), day, genre).agg(F.count("*").alias("plays")))
    total = F.sum("plays").over(W.partitionBy("user_id", "week", "weekday"))
    shares = counts.withColumn("share", F.col("plays") / total)
    nothing = F.lit(0.0)
    # Each share counts in its own week and as the previous value of the next one.
    entries = F.inline(F.array(
        F.struct(F.col("week").alias("week"), F.col("share").alias("share"),
                 nothing.alias("previous")),
        F.struct(F.date_add("week", 7).alias("week"), nothing.alias("share"),
                 F.col("share").alias("previous"))))
    last = plays.agg(F.max(_week())).scalar()
    return (shares.select("user_id", "weekday", genre, entries)
            .where(F.col("week") <= last)
            .groupBy("user_id", "week", "weekday", genre)
            .agg(F.max("share").alias("share"),
                 (F.max("share") - F.max("previous")).alias("change")))


def _neighbours(position: Column, letter: Column) -> Column:
    """Camelot codes that mix with one code: itself, one step either way, the other letter."""
    up, down = F.pmod(position, F.lit(12)) + 1, F.pmod(position + 10, F.lit(12)) + 1
    other = F.when(letter == "A", F.lit("B")).otherwise(F.lit("A"))
    return F.array(*[F.concat(p.cast("string"), x) for p, x in (
        (position, letter), (up, letter), (down, letter), (position, other))])


def bridge_tracks(tracks: DataFrame, styles: DataFrame, pairs: DataFrame, features: Sequence[str],
                  n: int = 5, tempo_range: float = 0.06) -> DataFrame:
    """Up to ``n`` tracks that lead from one style to another, closest first.

    ``tracks`` (one row per track) and ``styles`` have ``key, mode, tempo`` and the
    ``features``; ``pairs`` names the styles as ``from_style, to_style``. A track
    fits if its key neighbours those of both styles on the Camelot wheel and its
    tempo is within ``tempo_range`` of both. It is matched by equal key code and
    tempo bucket, against pairs that are first narrowed to the codes and buckets
    that fit. Distances are rounded to 6 digits.
    """
    letter = F.when(F.col("mode") == 1, F.lit("B")).otherwise(F.lit("A"))
    position = camelot_code("key", "mode")
    ends = styles.select("style", _neighbours(position, letter).alias("codes"),
                         (F.col("tempo") * (1 - tempo_range)).alias("slow"),
                         (F.col("tempo") * (1 + tempo_range)).alias("fast"), *features)

    def end(prefix: str) -> DataFrame:
        return ends.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ends.columns])

    width = math.log(1 + tempo_range)

    def bucket(tempo: Column) -> Column:
        return F.floor(F.ln(tempo) / width)

    low, high = F.greatest("from_slow", "to_slow"), F.least("from_fast", "to_fast")
    wanted = (pairs.join(end("from"), "from_style").join(end("to"), "to_style")
              .withColumn("slow", low).withColumn("fast", high)
              .where((F.col("slow") <= F.col("fast")) & (F.col("slow") > 0))
              .withColumn("code", F.explode(F.array_intersect("from_codes", "to_codes")))
              .withColumn("bucket", F.explode(F.sequence(bucket(F.col("slow")), bucket(F.col("fast")))))
              .drop("from_codes", "to_codes"))
    distance = F.lit(0.0)
    for f in features:
        distance = distance + F.abs(F.col(f) - F.col(f"from_{f}")) + F.abs(F.col(f) - F.col(f"to_{f}"))
    candidates = (tracks.where(F.col("tempo") > 0)
                  .withColumn("code", F.concat(position.cast("string"), letter))
                  .withColumn("bucket", bucket(F.col("tempo"))))
    matches = (candidates.join(wanted, ["code", "bucket"])
               .where(F.col("tempo").between(F.col("slow"), F.col("fast")))
               .withColumn("distance", F.round(distance, 6))
               .select("from_style", "to_style", "track_id", "distance"))
    return top_per_group(matches.where(F.col("distance").isNotNull()), ["from_style", "to_style"],
                         ["distance", "track_id"], n)


def style_profiles(tracks: DataFrame, features: Sequence[str], style: str = "genre") -> DataFrame:
    """Most common key and mode, mean tempo and mean features per style."""
    keys = tracks.groupBy(style, "key", "mode").agg(F.count("*").alias("n"))
    common = (top_per_group(keys, [style], [F.desc("n"), "key", "mode"], 1)
              .select(F.col(style).alias("style"), "key", "mode"))
    return common.join(group_means(tracks, [style], ["tempo", *features])
                       .withColumnRenamed(style, "style"), "style")


def star_schema(plays: DataFrame) -> dict[str, DataFrame]:
    """``dim_artists, dim_albums, dim_tracks, fact_plays`` out of played items.

    Names are those of the newest play. Dimensions are grouped, not ranked, so the
    newest row is found inside every partition before the shuffle.
    """
    def dimension(rows: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
        newest = F.max_by(F.struct(*attributes), F.struct("played_at", *attributes)).alias("newest")
        return (rows.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(newest)
                .select(key, "newest.*"))

    artists = plays.select("played_at", F.explode("artists").alias("artist")).select(
        "played_at", F.col("artist.id").alias("artist_id"), F.col("artist.name").alias("artist_name"))
    return {
        "dim_artists": dimension(artists, "artist_id", ["artist_name"]),
        "dim_albums": dimension(plays, "album_id", ["album_name"]),
        "dim_tracks": dimension(plays, "track_id", ["track_name", "album_id", "duration_ms"]),
        "fact_plays": plays.select(
            "user_id", "played_at", "track_id", "album_id",
            F.transform("artists", lambda a: a["id"]).alias("artist_ids"), "duration_ms"),
    }


def write_star_schema(plays: DataFrame, base: str, mode: str = "overwrite") -> None:
    """Write the star schema; plays are laid out by day."""
    for name, rows in star_schema(plays).items():
        if name == "fact_plays":
            rows = rows.withColumn("played_date", F.to_date(F.col("played_at").cast("timestamp")))
            rows.hint("rebalance", "played_date").write.mode(mode).partitionBy("played_date").parquet(
                f"{base}/{name}")
        else:
            rows.write.mode(mode).parquet(f"{base}/{name}")
