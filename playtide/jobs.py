"""Jobs to submit: publish plays, ingest messages, compact, leaderboards, top-tracks documents, seeds.

    python -m playtide.jobs ingest --path in --tables out --progress ckpt \\
        --play-topic plays --top-topic tops
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtide import build_session, schemas
from playtide.functions import market_used
from playtide.operators import catalog, plays
from playtide.sources import files, payloads, streams
from playtide.streaming import ingest as flow
from playtide.streaming import stores


def publish(spark: SparkSession, payload_path: str, topic: str, override: str | None = None,
            path: str | None = None, servers: str | None = None, multi_line: bool = True) -> None:
    """Recent-plays payloads as play events on a topic."""
    documents = payloads.read_payloads(spark, payload_path, "recent_plays", multi_line)
    events = plays.play_events(documents, market_used(F.lit(override).cast("string"), "country"))
    files.write_messages(files.topic_messages(events, topic), path, servers)


def leaderboards(spark: SparkSession, payload_path: str, n: int = 10, multi_line: bool = True) -> dict[str, DataFrame]:
    """Album and track leaderboards per user over the last plays of all recent-plays payloads."""
    rows = plays.recent_plays(payloads.read_payloads(spark, payload_path, "recent_plays", multi_line))

    def board(kind: str) -> DataFrame:
        labels = [f"{kind}_name", f"{kind}_artists"]
        stats = plays.listening_stats(rows, f"{kind}_id", labels)
        ranked = plays.leaderboard(stats, labels[0], n)
        return plays.leaderboard_lines(ranked, *labels).orderBy("user_id", "rank")

    return {"albums": board("album"), "tracks": board("track")}


def top_tracks(spark: SparkSession, payload_path: str, catalog_path: str, artist_path: str,
               override: str | None = None, multi_line: bool = True) -> DataFrame:
    """One top-tracks document per user: of the dominant artist of the last plays of all payloads."""
    documents = payloads.read_payloads(spark, payload_path, "recent_plays", multi_line)
    users = plays.newest_payloads(documents).select("user_id", "country", market_used(
        F.lit(override).cast("string"), "country").alias("market"))
    artists = payloads.read_payloads(spark, artist_path, "artist", multi_line).select(
        F.col("id").alias("artist_id"), F.col("name").alias("artist_name"))
    tracks = payloads.artist_top_tracks(payloads.read_payloads(spark, catalog_path, "artist_top_tracks", multi_line))
    dominant = plays.dominant_artist(plays.recent_plays(documents)).join(users, "user_id")
    named = plays.with_names(dominant, artists, "artist_id", "artist_name")
    return catalog.top_tracks_documents(named, tracks)


def ingest(spark: SparkSession, tables: str, progress: str, play_topic: str, top_topic: str,
           path: str | None = None, servers: str | None = None, once: bool = False,
           rate: int | None = None) -> None:
    """Messages of both topics into the tables of plays and top-tracks documents.

    ``rate`` bounds a batch: offsets of a broker, files of a folder.
    """
    routes = [flow.play_event_route(play_topic), flow.top_tracks_route(top_topic)]
    source = (streams.broker_stream(spark, servers, [r.topic for r in routes], rate) if servers
              else streams.file_stream(spark, path, rate))
    query = flow.ingest(source, routes, tables, progress, once=once)
    query.awaitTermination() if once else flow.run_until_stopped(query)


def compact(spark: SparkSession, tables: str, play_topic: str, top_topic: str, before: str) -> None:
    """Fold the batches of both tables together: plays of days before ``before``, all documents."""
    plays_route, tops = flow.play_event_route(play_topic), flow.top_tracks_route(top_topic)
    stores.compact_inserted(spark, f"{tables}/{plays_route.table}", plays_route.stored, plays_route.keys,
                            flow.ARRIVAL, before)
    stores.compact_latest(spark, f"{tables}/{tops.table}", tops.stored, tops.keys, flow.ARRIVAL)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="playtide")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *required: str, optional: Sequence[str] = ()) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        for option in optional:
            sub.add_argument(f"--{option}")
        return sub

    command("publish", "payloads", "topic", optional=["market", "path", "servers"])
    boards = command("leaderboards", "payloads", "output")
    boards.add_argument("--limit", type=int, default=10)
    command("compact", "tables", "play-topic", "top-topic", "before")
    command("top-tracks", "payloads", "catalog", "artists", "topic", optional=["market", "path", "servers"])
    messages = command("ingest", "tables", "progress", "play-topic", "top-topic", optional=["path", "servers"])
    messages.add_argument("--once", action="store_true")
    messages.add_argument("--rate", type=int, default=100_000, help="offsets, or files, of a batch at most")
    command("seed", "records", "schema", "table", optional=["key", "order"])
    for name in ("publish", "leaderboards", "top-tracks", "seed"):
        commands.choices[name].add_argument("--lines", action="store_true", help="JSON lines, which can be split")
    a = parser.parse_args(arguments)
    spark = build_session(f"playtide {a.command}")

    if a.command == "publish":
        publish(spark, a.payloads, a.topic, a.market, a.path, a.servers, not a.lines)
    elif a.command == "leaderboards":
        for title, board in leaderboards(spark, a.payloads, a.limit, not a.lines).items():
            board.write.mode("overwrite").parquet(f"{a.output}/{title}")
    elif a.command == "top-tracks":
        rows = top_tracks(spark, a.payloads, a.catalog, a.artists, a.market, not a.lines)
        files.write_messages(files.topic_messages(rows, a.topic), a.path, a.servers)
    elif a.command == "ingest":
        ingest(spark, a.tables, a.progress, a.play_topic, a.top_topic, a.path, a.servers, a.once, a.rate)
    elif a.command == "compact":
        compact(spark, a.tables, a.play_topic, a.top_topic, a.before)
    elif a.command == "seed":
        records = files.read_records(spark, a.records, a.schema, not a.lines)
        written = stores.seed_if_empty(records, a.table, a.key, a.order.split(",") if a.order else ())
        print("seeded" if written else "already has rows")


if __name__ == "__main__":
    main()
