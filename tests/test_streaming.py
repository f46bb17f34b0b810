import json
import os

import pytest
from pyspark.sql import functions as F

from playtide.schemas import TOP_TRACKS_EVENT_TYPE
from playtide.sources.streams import file_stream
from playtide.streaming import ingest as flow
from playtide.streaming import stores, windows

ROUTES = [flow.play_event_route("plays"), flow.top_tracks_route("tops")]


def play(user="u", track="t", at="2024-01-01T00:00:00Z", **more):
    return json.dumps({"event_type": "recent_play", "user_id": user, "track_id": track, "played_at": at, **more},
                      ensure_ascii=False)


def top(user="u", market="AT", name="n", kind=TOP_TRACKS_EVENT_TYPE, generated="2024"):
    return json.dumps({"event_type": kind, "user_id": user, "artist_id": "a", "market": market,
                       "artist_name": name, "generated_at": generated, "tracks": [{"rank": 1, "artists": [None]}]})


MESSAGES = [
    ("plays", play(track_name="Erste é")),
    ("plays", play(track_name="Zweite")),
    ("plays", play(track="t2", extra="x")),
    ("plays", "{oops"),
    ("plays", play(track="")),
    ("plays", "[1]"),
    ("plays", None),
    ("tops", top(name="old", generated="2025")),
    ("tops", top(name="new", generated="2023")),
    ("tops", top(kind="other")),
    ("tops", top(market=None)),
    ("news", play()),
    ("plays", play(at="no day")),
]


def put(folder, messages, first=0):
    folder.mkdir(exist_ok=True)
    for i, (topic, value) in enumerate(messages, first):
        file = folder / f"{i:04d}.json"
        file.write_text(json.dumps(
            {"topic": topic, "partition": 0, "offset": i, "timestamp": "2024-01-01T00:00:00Z", "value": value},
            ensure_ascii=False) + "\n", encoding="utf-8")
        # Files arrive in the order of their times.
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))


def run(spark, tmp_path, checkpoint, files=3):
    flow.ingest(file_stream(spark, str(tmp_path / "in"), files), ROUTES, str(tmp_path / "out"),
                str(tmp_path / checkpoint), once=True).awaitTermination()


def state(spark, tmp_path):
    base = str(tmp_path / "out")
    plays = flow.read_table(spark, ROUTES[0], base)
    tops = flow.read_table(spark, ROUTES[1], base)
    return (sorted(tuple(r) for r in plays.select("user_id", "track_id", "played_at", "track_name", "day").collect()),
            sorted(tuple(r) for r in tops.select("user_id", "artist_name").collect()))


def test_ingest_and_replay(spark, tmp_path):
    put(tmp_path / "in", MESSAGES)
    run(spark, tmp_path, "c1")
    want = ([("u", "t", "2024-01-01T00:00:00Z", "Erste é", "2024-01-01"),
             ("u", "t", "no day", None, "unknown"),
             ("u", "t2", "2024-01-01T00:00:00Z", None, "2024-01-01")], [("u", "new")])
    assert state(spark, tmp_path) == want
    rejects = {(r["offset"], r["reason"]) for r in flow.read_rejects(spark, str(tmp_path / "out")).collect()}
    assert rejects == {(3, "malformed"), (4, "missing key"), (5, "malformed"), (6, "malformed"),
                       (9, "unexpected event type"), (10, "missing key"), (11, "unknown topic")}
    # From the beginning on a new checkpoint, in batches of another size.
    run(spark, tmp_path, "c2", files=5)
    assert state(spark, tmp_path) == want
    # New messages on the old checkpoint.
    put(tmp_path / "in", [("plays", play(track="t3")), ("tops", top(name="newest"))], first=50)
    run(spark, tmp_path, "c1")
    plays, tops = state(spark, tmp_path)
    assert len(plays) == 4 and tops == [("u", "newest")]


def test_a_batch_that_failed_after_writing_is_written_again(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", MESSAGES)
    original, calls = flow.write_batch, []

    def failing(messages, routes, base, ingest):
        original(messages, routes, base, ingest)
        calls.append(ingest)
        if len(calls) == 2:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(flow, "write_batch", failing)
    with pytest.raises(Exception):
        run(spark, tmp_path, "c1")
    run(spark, tmp_path, "c1")
    assert calls[1] == calls[2] and len(set(calls)) == len(calls) - 1
    plays, tops = state(spark, tmp_path)
    assert len(plays) == 3 and tops == [("u", "new")]
    assert flow.read_rejects(spark, str(tmp_path / "out")).count() == 7


def test_batch_equals_stream(spark, tmp_path):
    put(tmp_path / "in", MESSAGES)
    run(spark, tmp_path, "c1", files=2)
    batch = spark.read.schema(flow.schemas.MESSAGE).json(str(tmp_path / "in"))
    flow.write_batch(batch, ROUTES, str(tmp_path / "once"), "only")
    streamed = state(spark, tmp_path)
    (tmp_path / "out").rename(tmp_path / "streamed")
    (tmp_path / "once").rename(tmp_path / "out")
    assert state(spark, tmp_path) == streamed


def test_preview_is_cut(spark):
    rows = spark.createDataFrame([("x", 0, 1, None, "y" * 500)],
                                 "topic string, partition int, offset bigint, timestamp timestamp, value string")
    assert flow.rejected(flow.parse_messages(rows, ROUTES)).first()["value_preview"] == "y" * 120


def test_routes_are_checked():
    with pytest.raises(ValueError):
        flow.Route("t", "t", flow.schemas.PLAY_EVENT, ("user_id",), "insert", day_of="played_at")
    with pytest.raises(ValueError):
        flow.Route("t", "t", flow.schemas.PLAY_EVENT, ("user_id",), "append")


def test_insert_over_many_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).select(F.col("id"), F.concat(F.lit("2024-01-0"), F.col("id") % 5 + 1).alias("at"))
    stores.insert_if_absent(rows.where("id < 6"), path, ["id", "at"], ["id"], "a", "at")
    stores.insert_if_absent(rows, path, ["id", "at"], ["id"], "b", "at")
    stores.insert_if_absent(rows, path, ["id", "at"], ["id"], "b", "at")
    assert stores.read_inserted(spark, path, rows.schema).count() == 10


def test_compaction_keeps_the_latest(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, seq int, v string")
    stores.upsert_latest(rows, path, ["k"], ["seq"], "x")
    stores.upsert_latest(rows.where("seq = 1"), path, ["k"], ["seq"], "y")
    for _ in range(2):
        stores.compact_latest(spark, path, rows.schema, ["k"], ["seq"])
        got = stores.read_latest(spark, path, rows.schema, ["k"], ["seq"])
        assert sorted(tuple(r) for r in got.collect()) == [(1, 2, "b"), (2, 1, "c")]
    assert len(stores._folders(spark, path)) == 1


def test_seed(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "_id string, n int")
    path = str(tmp_path / "seed")
    assert stores.seed_if_empty(rows.where("n > 9"), path)
    assert stores.seed_if_empty(rows, path, "_id", ["n"])
    assert not stores.seed_if_empty(rows, path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]
    assert [tuple(r) for r in stores.duplicate_keys(rows, "_id").collect()] == [("a", 2)]
    assert stores.seed_tables({"x": rows}, str(tmp_path)) == {"x": True}


def test_windowed_counts_drop_late_rows(spark, tmp_path):
    schema = "played_at timestamp, track_id string"

    def add(name, rows):
        folder = tmp_path / "plays"
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.json").write_text("".join(
            json.dumps({"played_at": f"2024-01-01T{t}Z", "track_id": k}) + "\n" for t, k in rows))

    def count():
        stream = spark.readStream.schema(schema).json(str(tmp_path / "plays"))
        counts = windows.windowed_counts(stream, ["track_id"], window="1 hour", delay="30 minutes")
        windows.keep_counts(counts, ["track_id"], str(tmp_path / "counts"), str(tmp_path / "c"),
                            once=True).awaitTermination()
        table = windows.read_counts(spark, str(tmp_path / "counts"), counts.schema, ["track_id"])
        return sorted((r["window_start"].hour, r["track_id"], r["plays"]) for r in table.collect())

    add("1", [("00:10:00", "a"), ("00:20:00", "a"), ("01:10:00", "b"), ("05:00:00", "c")])
    assert count() == [(0, "a", 2), (1, "b", 1), (5, "c", 1)]
    add("2", [("00:30:00", "a"), ("04:45:00", "c"), ("05:30:00", "c")])
    assert count() == [(0, "a", 2), (1, "b", 1), (4, "c", 1), (5, "c", 2)]


def test_run_until_stopped_stops_the_query(monkeypatch):
    import os
    import signal
    import threading

    class Query:
        isActive = True

        def stop(self):
            self.isActive = False

    before = {n: signal.getsignal(n) for n in (signal.SIGINT, signal.SIGTERM)}
    query = Query()
    threading.Timer(0.3, os.kill, (os.getpid(), signal.SIGTERM)).start()
    try:
        flow.run_until_stopped(query)
    finally:
        for number, handler in before.items():
            signal.signal(number, handler)
    assert not query.isActive


def test_whole_message_texts(spark):
    good = '{"user_id": "u", "track_id": "t", "played_at": "2024-01-01"}'
    cases = {"\n\t " + good + "\r\n": None, good + " xyz": "malformed", good + good: "malformed",
             good + "," + good: "malformed", "[" + good + "]": "malformed", good[:-1]: "malformed", "": "malformed",
             "null": "malformed", good.replace('"', "'"): "malformed", "{}": "missing key"}
    rows = spark.createDataFrame([("p", 0, i, None, text) for i, text in enumerate(cases)],
                                 "topic string, partition int, offset bigint, timestamp timestamp, value string")
    parsed = flow.parse_messages(rows, [flow.play_event_route("p")]).orderBy("offset").collect()
    assert [r["reason"] for r in parsed] == list(cases.values())


def test_insert_tables_read_only_the_days_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    day = "concat('2024-01-', lpad(cast(id % 9 + 10 as string), 2, '0'))"
    for i in range(20):
        rows = spark.range(40 * i, 40 * i + 60).selectExpr("id", f"{day} as at")
        stores.insert_if_absent(rows, path, ["id", "at"], ["id"], f"run-{i}", "at")
    assert stores.read_inserted(spark, path, rows.schema).count() == 40 * 19 + 60
    wanted = sorted(map(tuple, stores.read_inserted(spark, path, rows.schema).collect()))
    for _ in range(2):
        stores.compact_inserted(spark, path, rows.schema, ["id", "at"], ["id"], "2024-01-15")
    folders = {day: len(list((tmp_path / "t" / f"day=2024-01-{day}").glob("ingest=*"))) for day in (10, 14, 15)}
    assert folders[10] == folders[14] == 1 and folders[15] > 1
    assert sorted(map(tuple, stores.read_inserted(spark, path, rows.schema).collect())) == wanted
    stores.insert_if_absent(rows, path, ["id", "at"], ["id"], "run-again", "at")
    assert sorted(map(tuple, stores.read_inserted(spark, path, rows.schema).collect())) == wanted
    stored = spark.read.schema("id bigint, at string, day string, ingest string").parquet(path)
    batch = spark.createDataFrame([(1, "2024-01-11", "2024-01-11")], "id bigint, at string, day string")
    rows = stores.keep_first(batch, ["id", "at"], ["id"])
    plan = stores.stored_keys(stored, rows, ["id", "at"])._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_keyed_seed_needs_an_order(spark, tmp_path):
    with pytest.raises(ValueError):
        stores.seed_if_empty(spark.range(3), str(tmp_path / "s"), "id")
    rows = spark.createDataFrame([(1, 5), (1, 3)], "k int, n int")
    assert stores.seed_tables({"a": rows}, str(tmp_path), {"a": ("k", ["n"])}) == {"a": True}
    assert [r["n"] for r in spark.read.parquet(str(tmp_path / "a")).collect()] == [3]


def test_rejects_are_replayed_exactly_once(spark, tmp_path, monkeypatch):
    long = play(track="t9", note="x" * 500)
    put(tmp_path / "in", [*MESSAGES, ("extra", long), ("extra", play(track=""))])
    run(spark, tmp_path, "c1")
    base = str(tmp_path / "out")
    before = {r["offset"]: r["value"] for r in flow.open_rejects(spark, base).collect()}
    assert before[13] == long and {r["attempt"] for r in flow.open_rejects(spark, base).collect()} == {0}
    more = [*ROUTES, flow.play_event_route("extra"), flow.Route(
        "news", "play_events", flow.schemas.PLAY_EVENT, ("user_id", "track_id", "played_at"), "insert", day_of="played_at")]
    write = flow.LiveTable.write
    monkeypatch.setattr(flow.LiveTable, "write", lambda *_: (_ for _ in ()).throw(RuntimeError("lost after the tables")))
    with pytest.raises(RuntimeError):
        flow.replay_rejects(spark, more, base, 0)
    monkeypatch.setattr(flow.LiveTable, "write", write)
    for again in range(3):
        flow.replay_rejects(spark, more, base, min(again, 1))
    plays, _ = state(spark, tmp_path)
    assert [p[:3] for p in plays] == [("u", "t", "2024-01-01T00:00:00Z"), ("u", "t", "no day"),
                                      ("u", "t2", "2024-01-01T00:00:00Z"), ("u", "t9", "2024-01-01T00:00:00Z")]
    left = {r["offset"]: (r["attempt"], r["reason"]) for r in flow.open_rejects(spark, base).collect()}
    assert set(left) == set(before) - {11, 13} and left[14] == (2, "missing key") and left[3] == (2, "malformed")


def test_broker_reader_asks_for_all_topics_from_the_start(monkeypatch):
    from playtide.sources import streams
    asked = {}

    class Reader:
        def format(self, name):
            asked["format"] = name
            return self

        def option(self, name, value):
            asked[name] = value
            return self

        def load(self):
            return self

        def select(self, *columns):
            asked["columns"] = len(columns)
            return self

    class Spark:
        readStream = Reader()

    streams.broker_stream(Spark(), "host:1", ["a", "b"], 500)
    assert asked == {"format": "kafka", "kafka.bootstrap.servers": "host:1", "subscribe": "a,b",
                     "startingOffsets": "earliest", "maxOffsetsPerTrigger": 500, "columns": 5}
