"""Whole analyses composed of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide import schemas
from playtide.operators import catalog, correlation, distribution, plays as listening, tables
from playtide.operators.quantiles import group_medians


def track_leaderboard(plays: DataFrame, n: int = 10, last: int = schemas.RECENT_LIMIT,
                      tiebreak: Sequence[str] = ()) -> DataFrame:
    """Most played tracks among each user's last plays. One shuffle, by user."""
    recent = listening.last_n_plays(plays, last, tiebreak=tiebreak)
    stats = listening.listening_stats(recent, "track_id", ["track_name", "track_artists"])
    return listening.leaderboard(stats, "track_name", n)


def album_leaderboard(plays: DataFrame, n: int = 10, last: int = schemas.RECENT_LIMIT,
                      tiebreak: Sequence[str] = ()) -> DataFrame:
    """Most played albums among each user's last plays."""
    recent = listening.last_n_plays(plays, last, tiebreak=tiebreak)
    stats = listening.listening_stats(recent, "album_id", ["album_name", "album_artists"])
    return listening.leaderboard(stats, "album_name", n)


def dominant_artist_documents(plays: DataFrame, users: DataFrame, artists: DataFrame,
                              track_catalog: DataFrame, n: int = schemas.TOP_TRACKS,
                              last: int = schemas.RECENT_LIMIT, tiebreak: Sequence[str] = (),
                              now: Column | None = None) -> DataFrame:
    """Top tracks of each user's dominant artist in the user's market, as documents.

    ``users`` has ``user_id, country, market``, ``artists`` has ``artist_id, artist_name``.
    """
    recent = listening.last_n_plays(plays, last, tiebreak=tiebreak)
    dominant = listening.dominant_artist(recent).join(users, "user_id")
    named = listening.with_names(dominant, artists, "artist_id", "artist_name")
    return catalog.top_tracks_documents(named, track_catalog, n, now)


def genre_profile(tracks: DataFrame, columns: Sequence[str], stat: str = "mean",
                  by: str = "genre") -> DataFrame:
    """Mean or exact median of every column per genre."""
    if stat == "mean":
        return tables.group_means(tracks, [by], columns)
    if stat == "median":
        return group_medians(tracks, [by], columns)
    raise ValueError(f"unknown statistic {stat!r}")


def popularity_correlations(tracks: DataFrame, columns: Sequence[str], by: str = "genre",
                            target: str = "popularity", encode: str = "artists",
                            code: str = "artists_id") -> DataFrame:
    """Correlation of popularity with every column and the artist code per genre, sorted by the code's."""
    table = correlation.group_correlations(tracks, by, target, columns)
    name = f"corr_{target}_{code}"
    of_code = correlation.code_correlations(tracks, by, target, encode, tables.label_codes(tracks, encode, code),
                                            code, name)
    return table.join(of_code, by, "left").orderBy(F.desc_nulls_last(name), by)


def distribution_of(df: DataFrame, column: str, bins: int, points: int = 200) -> dict[str, DataFrame]:
    """Histogram, density curve and box summary of one column."""
    return {"histogram": distribution.histogram(df, column, bins),
            "density": distribution.density(df, column, points),
            "box": distribution.box_summary(df, column)}
