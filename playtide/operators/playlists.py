"""Playlists: their tracks, audio profiles, first choices per genre, genre comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playtide import schemas
from playtide.functions import composite_key
from playtide.operators.tables import by_value, group_means, keep_first
from playtide.sources.payloads import listed_tracks


def playlist_table(items: DataFrame) -> DataFrame:
    """Playlist entries with track and album fields pulled up and a composite ``_id``.

    An entry without a track keeps its row with null fields.
    """
    t = F.col("track")
    flat = items.select(
        *[c for c in items.columns if c != "track"],
        t["id"].alias("track_id"), t["album"]["id"].alias("album_id"),
        t["name"].alias("track_name"), t["album"]["name"].alias("album_name"))
    return flat.withColumn("_id", composite_key("track_id", "playlist_id"))


def first_of_each_track(entries: DataFrame, playlist: str = "playlist_id", track: str = "track_id",
                        order: Sequence[Column | str] = ("position",)) -> DataFrame:
    """Entries without repeats of a track in a playlist; the first one stays."""
    return keep_first(entries, [playlist, track], order)


def playlist_tracks(items: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct named tracks of each playlist, all or among its first ``limit`` raw entries.

    The limit counts raw entries, so fewer tracks may be left.
    """
    reached = items if limit is None else items.where(F.col("position") < limit)
    return first_of_each_track(listed_tracks(reached))


def positions(entries: DataFrame, playlist: str, order: Sequence[Column | str]) -> DataFrame:
    """All entries with their 0-based ``position`` in the playlist."""
    window = W.partitionBy(playlist).orderBy(*order)
    return entries.withColumn("position", F.row_number().over(window) - 1)


def first_entries(entries: DataFrame, n: int, playlist: str, order: Sequence[Column | str]) -> DataFrame:
    """The first ``n`` entries per playlist with their 0-based ``position``."""
    return positions(entries, playlist, order).where(F.col("position") < n)


def complete_features(features: DataFrame, columns: Sequence[str] = schemas.PROFILE_FEATURES,
                      prefix: str = "") -> DataFrame:
    """Features kept all or none: if one is missing, the row stays with all of them null."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(prefix + c).isNotNull()
    others = [c for c in features.columns if c not in columns]
    return features.select(*others, *[F.when(complete, F.col(prefix + c)).alias(c) for c in columns])


def playlist_audio_profile(entries: DataFrame, playlist: str = "playlist_name",
                           columns: Sequence[str] = schemas.PROFILE_FEATURES,
                           order: str = "danceability") -> DataFrame:
    """Mean features per playlist, lowest ``order`` first, playlists without any last."""
    return by_value(group_means(complete_features(entries, columns), [playlist], columns),
                    order, tiebreak=[playlist])


def search_terms(genres: DataFrame, fallbacks: Sequence[str] = ()) -> DataFrame:
    """``genre, query, priority``: the genre itself, then each fallback text with it filled in."""
    texts = ["{}", *fallbacks]
    filled = F.array(*[F.replace(F.lit(t), F.lit("{}"), F.col("genre")) for t in texts])
    return genres.select("genre", F.posexplode(filled).alias("priority", "query"))


def pick_playlists(genres: DataFrame, searches: DataFrame, fallbacks: Sequence[str] = (),
                   limit: int | None = None) -> DataFrame:
    """The first playlist found per genre; later search texts count only if none was found.

    ``searches`` has ``query, position, playlist_id`` with the positions of usable
    results; with a ``limit``, later positions are out of a result's reach.
    """
    reached = searches if limit is None else searches.where(F.col("position") < limit)
    found = search_terms(genres, fallbacks).join(reached, "query")
    return keep_first(found, ["genre"], ["priority", "position"]).drop("priority", "position", "query")


def genre_tracks(genres: DataFrame, searches: DataFrame, items: DataFrame,
                 n: int | None = None, fallbacks: Sequence[str] = (), found: int | None = None) -> DataFrame:
    """Tracks of each genre's playlist; genres without a playlist are left out.

    ``n`` limits the raw entries of a playlist, ``found`` the results of a search. Entries
    are narrowed to the few picked playlists before anything else is done with them.
    """
    picked = pick_playlists(genres, searches, fallbacks, found).select("genre", "playlist_id")
    tracks = playlist_tracks(items.join(picked, "playlist_id", "left_semi"), n)
    return picked.join(tracks, "playlist_id")


def compare_genres(genres: DataFrame, searches: DataFrame, items: DataFrame, analysis: DataFrame,
                   n: int | None = None, feature: str = "danceability",
                   fallbacks: Sequence[str] = (), found: int | None = None) -> DataFrame:
    """Mean of a feature over all or the first ``n`` playlist entries per genre, highest first.

    Genres without a playlist or without any value stay, with a null mean and 0 tracks.
    """
    tracks = genre_tracks(genres, searches, items, n, fallbacks, found).select("genre", "track_id")
    values = tracks.join(analysis.select("track_id", feature), "track_id", "left")
    means = values.groupBy("genre").agg(F.avg(feature).alias(f"avg_{feature}"),
                                        F.count(feature).alias("n_tracks"))
    return genres.select("genre").join(means, "genre", "left").select(
        "genre", f"avg_{feature}", F.coalesce("n_tracks", F.lit(0).cast("bigint")).alias("n_tracks"),
    ).orderBy(F.desc_nulls_last(f"avg_{feature}"), "genre")


def genre_list(spark, genres: Sequence[str] = tuple(schemas.GENRES)) -> DataFrame:
    """The driving genres in their order."""
    return spark.createDataFrame([(g, i) for i, g in enumerate(genres)], "genre string, place int")
