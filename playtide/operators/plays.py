"""Plays: events out of payloads, last plays per user, listening stats, leaderboards.

Every grouping by user works on rows that were cut to a fixed number per user
before they are shuffled (``last_n_plays``), so a user with a large share of all
plays does not make a large task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playtide import schemas
from playtide.functions import first_by, int_or_zero, join_names, present, present_values, utc_now_iso
from playtide.operators.tables import keep_first
from playtide.sources.payloads import recent_items


def play_events(payloads: DataFrame, market: Column | str | None = None,
                now: Column | None = None) -> DataFrame:
    """One flat 15-field event per played item of every recent-plays payload.

    ``payloads`` carries ``user_id`` and ``country`` next to ``items``. ``now`` is
    the generation time (default: the current time).
    """
    market = F.col("country") if market is None else (
        F.col(market) if isinstance(market, str) else market)
    track = F.col("track")
    fields = {
        "event_version": F.lit(schemas.EVENT_VERSION),
        "event_type": F.lit(schemas.PLAY_EVENT_TYPE),
        "generated_at": utc_now_iso(now),
        "user_id": F.col("user_id"),
        "country": F.col("country"),
        "market_used": F.col("market_used"),
        "played_at": F.col("played_at"),
        "track_id": track["id"],
        "track_name": track["name"],
        "track_duration_ms": int_or_zero(track["duration_ms"]),
        "album_id": track["album"]["id"],
        "album_name": track["album"]["name"],
        "album_release_date": track["album"]["release_date"],
        "artist_ids": present_values(track["artists"], "id"),
        "artist_names": present_values(track["artists"], "name"),
    }
    items = recent_items(payloads.withColumn("market_used", market))
    return items.select(*[value.alias(name) for name, value in fields.items()])


def play_rows(payloads: DataFrame) -> DataFrame:
    """Played items with the ids, names and artist texts the leaderboards show."""
    track, album = F.col("track"), F.col("track.album")
    items = recent_items(payloads)
    return items.select(
        "user_id", "idx", "played_at", *[c for c in items.columns if c == "seen_at"],
        track["id"].alias("track_id"), F.coalesce(track["name"], F.lit("?")).alias("track_name"),
        join_names(track["artists"]).alias("track_artists"),
        album["id"].alias("album_id"), F.coalesce(album["name"], F.lit("?")).alias("album_name"),
        join_names(album["artists"]).alias("album_artists"),
        track["artists"].alias("artists"))


def recent_plays(payloads: DataFrame, n: int = schemas.RECENT_LIMIT) -> DataFrame:
    """Each user's newest ``n`` plays out of any number of payloads, which may overlap.

    A play is known by its user, track and time; the same play in several payloads counts once.
    Payloads are newest first, so a play without a time is as new as the next one with a time.
    """
    def seen_at(item: Column, place: Column) -> Column:
        later = F.transform(F.slice("items", place + 1, F.size("items")), lambda other: other["played_at"])
        return F.coalesce(item["played_at"], F.array_max(later))

    items = F.transform("items", lambda item, place: F.struct(
        item["played_at"].alias("played_at"), item["track"].alias("track"), seen_at(item, place).alias("seen_at")))
    rows = keep_first(play_rows(payloads.withColumn("items", items)), ["user_id", "track_id", "played_at"], ["idx"])
    return last_n_plays(rows, n, played_at="seen_at", tiebreak=["idx", "track_id"]).drop("seen_at")


def newest_payloads(payloads: DataFrame) -> DataFrame:
    """One payload per user: the one with the newest play, then with a country, then by country."""
    newest = F.array_max(F.transform("items", lambda item: item["played_at"]))
    return keep_first(payloads.withColumn("_newest", newest), ["user_id"], [
        F.desc_nulls_last("_newest"), F.asc_nulls_last(F.nullif("country", F.lit("")))]).drop("_newest")


def last_n_plays(plays: DataFrame, n: int = schemas.RECENT_LIMIT, by: Sequence[str] = ("user_id",),
                 played_at: str = "played_at", tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest ``n`` plays per user with their position ``idx`` (0 is the newest).

    The rank filter is applied before the shuffle as well (WindowGroupLimit).
    """
    newest = W.partitionBy(*by).orderBy(F.desc_nulls_last(played_at), *tiebreak)
    return (plays.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= n)
            .withColumn("idx", F.col("rn") - 1).drop("rn"))


def listening_stats(plays: DataFrame, key: str, labels: Sequence[str] = (),
                    by: Sequence[str] = ("user_id",)) -> DataFrame:
    """Plays, first position and newest non-empty time per user and track or album.

    ``labels`` are taken from the row of the first position.
    """
    plays = plays.where(present(key))
    timed = present("played_at") if dict(plays.dtypes)["played_at"] == "string" else \
        F.col("played_at").isNotNull()
    first = [first_by(F.struct(*labels), F.col("idx")).alias("first")] if labels else []
    stats = plays.groupBy(*by, key).agg(
        F.count("*").alias("plays"),
        F.min("idx").alias("first_idx"),
        first_by(F.col("played_at"), F.col("idx"), timed).alias("latest_played_at"),
        *first)
    shown = [F.col("first")[c].alias(c) for c in labels]
    return stats.select(*by, key, "plays", "first_idx", "latest_played_at", *shown)


def leaderboard(stats: DataFrame, name: str, n: int = 10,
                by: Sequence[str] = ("user_id",)) -> DataFrame:
    """The ``n`` most played entries per user: most plays, then earliest position, then name."""
    order = W.partitionBy(*by).orderBy(F.desc("plays"), "first_idx", F.lower(F.col(name)))
    return stats.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def leaderboard_lines(board: DataFrame, name: str, artists: str) -> DataFrame:
    """A ``line`` per entry, e.g. ``01. Title — Artist  | plays=3  | latest=...``."""
    line = F.format_string("%02d. %s — %s  | plays=%d  | latest=%s", "rank", name, artists,
                           "plays", F.coalesce(F.col("latest_played_at").cast("string"), F.lit("None")))
    return board.withColumn("line", line)


def artist_counts(plays: DataFrame, artists: str = "artists",
                  by: Sequence[str] = ("user_id",)) -> DataFrame:
    """How often each artist id occurs in a user's plays and where it is seen first."""
    seen = (plays.select(*by, "idx", F.posexplode(F.col(artists)).alias("pos", "artist"))
            .withColumn("artist_id", F.col("artist.id")).where(present("artist_id")))
    return seen.groupBy(*by, "artist_id").agg(
        F.count("*").alias("plays"), F.min(F.struct("idx", "pos")).alias("first_seen"))


def top_artists(plays: DataFrame, n: int = 5, artists: str = "artists",
                by: Sequence[str] = ("user_id",)) -> DataFrame:
    """The ``n`` most frequent artists per user; ties go to the one seen first."""
    order = W.partitionBy(*by).orderBy(F.desc("plays"), "first_seen")
    return (artist_counts(plays, artists, by)
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
            .select(*by, "rank", "artist_id", "plays"))


def dominant_artist(plays: DataFrame, artists: str = "artists",
                    by: Sequence[str] = ("user_id",)) -> DataFrame:
    """The most frequent artist per user; users without any artist id have no row."""
    return top_artists(plays, 1, artists, by).drop("rank")


def with_names(rows: DataFrame, dimension: DataFrame, key: str, name: str,
               missing: str = "?") -> DataFrame:
    """Display names from a dimension with one row per key; ``missing`` where there is none."""
    names = dimension.select(key, F.col(name).alias("_name"))
    return (rows.join(names, key, "left")
            .withColumn(name, F.coalesce("_name", F.lit(missing))).drop("_name"))


def batch_summary(plays: DataFrame, by: Sequence[str] = ("user_id",)) -> DataFrame:
    """Number of plays and the time of the newest one."""
    return plays.groupBy(*by).agg(
        F.count("*").alias("plays"),
        first_by(F.col("played_at"), F.col("idx")).alias("newest_played_at"))


def timeline(plays: DataFrame, user: str = "user_id", played_at: str = "played_at",
             tiebreak: Sequence[str] = ()) -> DataFrame:
    """Plays per user, newest first. Range-sorted on both, so a busy user is split too."""
    return plays.orderBy(user, F.desc_nulls_last(played_at), *tiebreak)


def write_timeline(plays: DataFrame, path: str, user: str = "user_id",
                   played_at: str = "played_at", mode: str = "append") -> None:
    """Plays by day, each file sorted for per-user timelines so readers can skip row groups."""
    day = F.to_date(F.col(played_at).try_cast("timestamp"))
    (plays.withColumn("played_date", day).hint("rebalance", "played_date")
     .sortWithinPartitions("played_date", user, F.desc_nulls_last(played_at))
     .write.mode(mode).partitionBy("played_date").parquet(path))


def newest_first(snapshots: DataFrame, generated_at: str = "generated_at",
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """Stored snapshots, newest generation first."""
    return snapshots.orderBy(F.desc_nulls_last(generated_at), *tiebreak)
