"""Readers and flatteners for nested JSON payloads that a collector left as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide import schemas
from playtide.functions import join_present_names, present

SCHEMAS = {
    "recent_plays": schemas.RECENT_PLAYS,
    "album_pages": schemas.ALBUM_PAGE,
    "artist_top_tracks": schemas.ARTIST_TOP_TRACKS,
    "user_playlists": schemas.USER_PLAYLISTS,
    "playlist_tracks": schemas.PLAYLIST_TRACKS,
    "playlist_search": schemas.SEARCH_RESULT,
    "profile": schemas.PROFILE,
    "artist": schemas.ARTIST_META,
    "album": schemas.ALBUM,
}


def read_payloads(spark: SparkSession, path: str, kind: str, multi_line: bool = True) -> DataFrame:
    """Payload files of one kind under ``path``, one row per document.

    ``multi_line`` files hold one document each. Collectors that write at volume
    should leave JSON lines (``multi_line=False``): those files can be split.
    """
    return spark.read.schema(SCHEMAS[kind]).json(path, multiLine=multi_line)


def parse_payloads(texts: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Payload texts in ``column`` as nested columns; unreadable texts give null fields."""
    parsed = F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"})
    return texts.withColumn(column, parsed).select(
        *[c for c in texts.columns if c != column], f"{column}.*")


def recent_items(payloads: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per played item with its position ``idx`` (0 is the newest), all or the first ``limit``."""
    keep = [c for c in payloads.columns if c != "items"]
    items = F.col("items") if limit is None else F.slice("items", 1, limit)
    return payloads.select(*keep, F.posexplode(items).alias("idx", "item")).select(*keep, "idx", "item.*")


def paged_items(pages: DataFrame, by: str = "album_id") -> DataFrame:
    """Items of all pages with their ``position`` over the pages."""
    return (pages.select(by, "offset", F.posexplode("items").alias("pos", "item"))
            .select(by, (F.coalesce("offset", F.lit(0)) + F.col("pos")).alias("position"), "item.*"))


def artist_top_tracks(payloads: DataFrame) -> DataFrame:
    """Catalogue rows ``(artist_id, market, position, track)`` in the order received."""
    return payloads.select("artist_id", "market",
                           F.posexplode("tracks").alias("position", "track"))


def search_results(payloads: DataFrame, limit: int | None = None) -> DataFrame:
    """Playlists found per query, all or among the first ``limit``, without those lacking an id or a name."""
    items = F.col("playlists.items") if limit is None else F.slice("playlists.items", 1, limit)
    found = payloads.select("query", F.posexplode(items).alias("position", "item"))
    return (found.where(present("item.id") & present("item.name"))
            .select("query", "position", F.col("item.id").alias("playlist_id"),
                    F.col("item.name").alias("playlist_name")))


def user_playlists(payloads: DataFrame) -> DataFrame:
    """One row per playlist of a user."""
    item = F.explode("items").alias("item")
    return payloads.select(item).select(
        F.col("item.id").alias("playlist_id"), F.col("item.name").alias("playlist_name"),
        F.col("item.owner.id").alias("owner_id"), F.col("item.tracks.href").alias("href"))


def playlist_items(payloads: DataFrame) -> DataFrame:
    """Raw playlist entries with their position; playlist columns are carried along."""
    keep = [c for c in payloads.columns if c != "items"]
    return payloads.select(*keep, F.posexplode("items").alias("position", "item")).select(
        *keep, "position", "item.track")


def listed_tracks(items: DataFrame) -> DataFrame:
    """Entries that name a track, as ``track_id, track_name, artists``."""
    keep = [c for c in items.columns if c != "track"]
    return (items.where(present("track.id") & present("track.name"))
            .select(*keep, F.col("track.id").alias("track_id"),
                    F.col("track.name").alias("track_name"),
                    join_present_names("track.artists").alias("artists")))


def analysis_features(texts: DataFrame, column: str = "analysis",
                      fields: list[str] = schemas.ANALYSIS_FIELDS) -> DataFrame:
    """Audio features out of analysis documents kept as JSON text.

    A feature is looked up at the top level, then inside ``audio_features``. The
    first one found counts, and is kept only if it is a number. Texts that are no
    JSON object give null features; the row stays.
    """
    document = F.try_parse_json(column)

    def feature(name: str) -> Column:
        top = F.try_variant_get(document, f"$.{name}", "variant")
        nested = F.try_variant_get(document, f"$.audio_features.{name}", "variant")
        value = F.when(top.isNull() | F.is_variant_null(top), nested).otherwise(top)
        kind = F.schema_of_variant(value)
        number = kind.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | kind.startswith("DECIMAL")
        return F.when(number, F.try_variant_get(value, "$", "double")).alias(name)

    keep = [c for c in texts.columns if c != column]
    return texts.select(*keep, *[feature(name) for name in fields])
