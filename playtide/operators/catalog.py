"""Top tracks of artists per market, as rows and as documents; album track lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playtide import schemas
from playtide.functions import join_names, ms_to_mmss, utc_now_iso


def top_per_group(rows: DataFrame, by: Sequence[str], order: Sequence[Column | str],
                  n: int) -> DataFrame:
    """The first ``n`` rows per group with their 1-based ``rank``."""
    window = W.partitionBy(*by).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def ranked_tracks(catalog: DataFrame, n: int = schemas.TOP_TRACKS) -> DataFrame:
    """The first ``n`` catalogue tracks per artist and market, in the order received."""
    return top_per_group(catalog, ["artist_id", "market"], ["position"], n)


def artist_top_tracks(dominant: DataFrame, catalog: DataFrame,
                      n: int = schemas.TOP_TRACKS) -> DataFrame:
    """Top tracks of each user's dominant artist in the user's market; none, no rows."""
    return dominant.join(ranked_tracks(catalog, n), ["artist_id", "market"])


def track_lines(ranked: DataFrame, track: str = "track") -> DataFrame:
    """A ``line`` per ranked track, e.g. ``01. Title — Artist (03:25)``."""
    t = F.col(track)
    return ranked.withColumn("line", F.format_string(
        "%02d. %s — %s (%s)", "rank", F.coalesce(t["name"], F.lit("?")),
        join_names(t["artists"]), ms_to_mmss(t["duration_ms"])))


def top_tracks_documents(dominant: DataFrame, catalog: DataFrame, n: int = schemas.TOP_TRACKS,
                         now: Column | None = None) -> DataFrame:
    """One document per user with the ranked tracks of the dominant artist.

    ``dominant`` has ``user_id, country, market, artist_id, artist_name``. An artist
    without catalogue tracks gives an empty list. Track lists are built once per
    artist and market (at most ``n`` entries) before the join with the users.
    """
    track = F.col("track")
    entry = F.struct(
        F.col("rank").cast("int").alias("rank"), track["id"].alias("track_id"),
        track["name"].alias("track_name"), track["duration_ms"].alias("duration_ms"),
        track["album"]["id"].alias("album_id"), track["album"]["name"].alias("album_name"),
        F.transform(track["artists"], lambda a: a["name"]).alias("artists"))
    lists = (ranked_tracks(catalog, n).select("artist_id", "market", entry.alias("entry"))
             .groupBy("artist_id", "market")
             .agg(F.array_sort(F.collect_list("entry")).alias("tracks")))
    none = F.array().cast(schemas.TOP_TRACKS_DOCUMENT["tracks"].dataType)
    return dominant.join(lists, ["artist_id", "market"], "left").select(
        F.lit(schemas.EVENT_VERSION).alias("event_version"),
        F.lit(schemas.TOP_TRACKS_EVENT_TYPE).alias("event_type"),
        utc_now_iso(now).alias("generated_at"),
        "user_id", "country", "market", "artist_id", "artist_name",
        F.coalesce("tracks", none).alias("tracks"))


def album_track_list(tracks: DataFrame, album: str = "album_id", duration: str = "duration_ms",
                     keep: Sequence[str] = ()) -> DataFrame:
    """Tracks of albums with ``mm:ss`` durations and the run time of the whole album.

    The run time is summed per album first and joined back, so that an album does
    not have to pass through one window task. Tracks that are dealt by album already
    (see ``session.dealt``) are summed and joined where they are.
    """
    totals = tracks.groupBy(album).agg(F.sum(duration).alias("album_ms"),
                                       F.count("*").alias("album_tracks"))
    return (tracks.select(album, *keep, duration).join(totals, album)
            .withColumn("length", ms_to_mmss(duration))
            .withColumn("album_length", ms_to_mmss("album_ms")))
