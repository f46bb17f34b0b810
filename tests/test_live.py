import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.streaming import live, rankings
from playtide.streaming.live import LiveTable

ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("v", T.StringType())])
PLAY = [T.StructField("user_id", T.StringType()), T.StructField("played_at", T.TimestampType()),
        T.StructField("event_id", T.LongType()), T.StructField("track", T.StringType())]


def latest(path, **more):
    return LiveTable(str(path), ROW, ("k",), ("seq",), "last", **more)


def rows_of(spark, rows):
    return spark.createDataFrame(rows, ROW)


def state(spark, table):
    return sorted(map(tuple, table.read(spark).collect()))


def test_last_row_per_key_over_many_batches(spark, tmp_path):
    rng = random.Random(1)
    table, kept = latest(tmp_path / "t", buckets=3), {}
    for number in range(10):
        batch = [(rng.randrange(12), rng.randrange(1000), f"{number}-{i}") for i in range(8)]
        for k, seq, v in batch:
            if k not in kept or seq > kept[k][1]:
                kept[k] = (k, seq, v)
        assert table.write(rows_of(spark, batch), "w", number)
        if number in (3, 9):
            assert [r[:2] for r in state(spark, table)] == sorted(r[:2] for r in kept.values())
    version = table.version(spark)
    tiers = Counter(version.folders.values())
    assert max(tiers.values()) < live.FAN and len(version.folders) <= 4 and version.done == {"w": 9}
    assert not table.write(rows_of(spark, [(1, 10**6, "late retry")]), "w", 9)
    assert [r[:2] for r in state(spark, table)] == sorted(r[:2] for r in kept.values())
    table.compact(spark)
    assert len(table.version(spark).folders) == 1 and len(state(spark, table)) == len(kept)
    # Folders that left the list go after a few versions, and old versions with them.
    for number in range(10, 10 + live.GRACE + 1):
        table.write(rows_of(spark, []), "w", number)
    version = table.version(spark)
    on_disk = {name[5:] for name in os.listdir(tmp_path / "t/data") if name.startswith("part=")}
    assert on_disk == set(version.folders) | set(version.retired)
    assert len([n for n in os.listdir(tmp_path / "t/live") if n.endswith(".json")]) <= live.GRACE + 1


@pytest.mark.parametrize("keep", ["first", "last"])
def test_readers_between_all_steps(spark, tmp_path, monkeypatch, keep):
    """At every step a reader sees the table before or after the batch, and no key twice."""
    table = LiveTable(str(tmp_path / "t"), ROW, ("k",), ("seq",), keep, buckets=2)
    seen = []

    def watch(name):
        step = getattr(LiveTable, name)

        def watched(self, *args):
            seen.append(state(spark, table))
            done = step(self, *args)
            seen.append(state(spark, table))
            return done
        monkeypatch.setattr(LiveTable, name, watched)

    for name in ("_write_folder", "_publish", "_merge"):
        watch(name)
    states = [[]]
    for number in range(live.FAN):
        table.write(rows_of(spark, [(number, 1, "own"), (0, number, "shared")]), "w", number)
        states.append(state(spark, table))
    assert all(len({r[0] for r in s}) == len(s) for s in seen)
    places = [states.index(s) for s in seen]
    assert places == sorted(places) and len(seen) >= 4 * live.FAN + 4
    shared = {r[0]: r for r in states[-1]}[0]
    assert shared == ((0, 0, "shared") if keep == "first" else (0, live.FAN - 1, "shared"))


def test_a_lost_write_changes_nothing_and_is_written_again(spark, tmp_path, monkeypatch):
    table = latest(tmp_path / "t")
    table.write(rows_of(spark, [(1, 1, "a")]), "w", 0)
    publish = LiveTable._publish
    monkeypatch.setattr(LiveTable, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.write(rows_of(spark, [(1, 2, "b")]), "w", 1)
    assert state(spark, table) == [(1, 1, "a")]
    monkeypatch.setattr(LiveTable, "_publish", publish)
    assert table.write(rows_of(spark, [(1, 2, "b")]), "w", 1)
    assert state(spark, table) == [(1, 2, "b")]


def test_a_second_writer_is_refused(spark, tmp_path):
    table = latest(tmp_path / "t")
    table.write(rows_of(spark, [(1, 1, "a")]), "w", 0)
    stale = live.Version()
    with pytest.raises(RuntimeError):
        table._publish(spark, stale, [], [], 0, {})


def test_look_ups_read_the_buckets_of_their_keys_without_a_shuffle(spark, tmp_path):
    table = latest(tmp_path / "t", buckets=64)
    table.write(spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).cast("bigint").alias("seq"), F.lit("v").alias("v")), "w", 0)
    keys = rows_of(spark, [(5, 0, ""), (7, 0, "")]).select("k")
    stored = table._folders(spark, table.version(spark).folders)
    found = table._matched(stored, table._bucketed(keys))
    assert sorted(r.k for r in found.collect()) == [5, 7]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    above = plan.split("FileScan parquet")[0]
    assert "BroadcastHashJoin" in above and "Exchange hashpartitioning" not in above.split("BroadcastExchange")[0]
    files = {os.path.dirname(f) for f in stored.where(F.col("bucket").isin(
        [r.bucket for r in table._bucketed(keys).collect()])).inputFiles()}
    assert "PartitionFilters" in plan and len({os.path.basename(f) for f in files}) >= 1
    scans = [n for n in plan.splitlines() if "FileScan parquet" in n]
    assert all("bucket" in n.split("PartitionFilters")[1] for n in scans)
    assert sorted(r.k for r in table.lookup(keys).collect()) == [5, 7]


def test_insert_keeps_the_first(spark, tmp_path):
    table = LiveTable(str(tmp_path / "t"), ROW, ("k",), ("seq",))
    table.write(rows_of(spark, [(1, 5, "a"), (1, 4, "b"), (None, 1, "n")]), "w", 0)
    table.write(rows_of(spark, [(1, 1, "later"), (2, 1, "c")]), "w", 1)
    assert [r for r in state_plain(spark, table) if r[0] is not None] == [(1, 4, "b"), (2, 1, "c")]
    with pytest.raises(ValueError):
        LiveTable("p", ROW, ("k",), ("seq",), "any")


def state_plain(spark, table):
    return sorted(map(tuple, table.read(spark).collect()), key=str)


def plays_of(rng, count, users=3):
    return [(f"u{rng.randrange(users)}", f"2024-01-01 0{rng.randrange(4)}:{rng.randrange(60):02d}:00", i, f"t{rng.randrange(6)}")
            for i in range(count)]


def test_last_plays_with_late_and_repeated_batches(spark, tmp_path):
    rng = random.Random(5)
    plays = plays_of(rng, 120) + [("u0", None, 500, "t"), ("u9", None, 501, "t"), (None, "2024-01-01 00:00:00", 502, "t")]
    frame = lambda rows: spark.createDataFrame(rows, "user_id string, at string, event_id bigint, track string").select(
        "user_id", F.col("at").cast("timestamp").alias("played_at"), "event_id", "track")
    fields = PLAY
    table = rankings.last_plays_table(str(tmp_path / "t"), fields[1:], fields[0])
    rng.shuffle(plays)
    batches = [plays[:40], plays[30:80], plays[:40], [], plays[80:], plays]
    for number, batch in enumerate(batches):
        rankings.merge_last_plays(frame(batch), table, ["event_id"], 7, "w", number)
    rankings.merge_last_plays(frame(plays[:1]), table, ["event_id"], 7, "w", 2)  # an old batch again
    got = rankings.read_last_plays(spark, str(tmp_path / "t"), fields[1:], fields[0])
    by_user = defaultdict(list)
    for r in got.where("user_id is not null").orderBy("user_id", "idx").collect():
        by_user[r.user_id].append(r.event_id)
    wanted = defaultdict(list)
    for user, at, event, _ in sorted(plays, key=lambda p: p[2]):
        wanted[user].append((at, event))
    for user in (u for u in wanted if u):
        newest = sorted(wanted[user], key=lambda x: (x[0] is None, "".join(chr(255 - ord(c)) for c in x[0] or ""), x[1]))[:7]
        assert by_user[user] == [e for _, e in newest]


def test_top_lists_take_back_entries(spark, tmp_path):
    """Late plays change lists of past hours; the changes alone rebuild the lists."""
    rng = random.Random(9)
    plays = plays_of(rng, 150)
    key = [T.StructField("track", T.StringType())]
    folder, counts = tmp_path / "in", Counter()
    folder.mkdir()
    for part in range(3):
        batch = plays[part::3]
        spark.createDataFrame(batch, "user_id string, at string, event_id bigint, track string").select(
            F.col("at").cast("timestamp").alias("played_at"), "track").coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema("played_at timestamp, track string").parquet(str(folder))
        rankings.keep_top_lists(stream, ["track"], str(tmp_path / "t"), str(tmp_path / "c"), 3, delay="1 day",
                                once=True).awaitTermination()
        counts.update((at[:13], track) for _, at, _, track in batch)
        lists = defaultdict(list)
        for r in rankings.read_top_lists(spark, str(tmp_path / "t"), key).orderBy("window_start", "rank").collect():
            assert r.rank == len(lists[str(r.window_start)[:13]]) + 1
            lists[str(r.window_start)[:13]].append((r.track, r.plays))
        for hour in {h for h, _ in counts}:
            own = sorted(((t, n) for (h, t), n in counts.items() if h == hour), key=lambda x: (-x[1], x[0]))
            assert lists[hour] == own[:3]
    followed = defaultdict(dict)
    for r in rankings.read_changes(spark, str(tmp_path / "t"), key).orderBy("batch", F.expr("change <> 'leave'")).collect():
        hour = str(r.window_start)[:13]
        if r.change == "leave":
            followed[hour].pop(r.track)
        else:
            followed[hour][r.track] = r["rank"]
    assert {h: sorted(t, key=t.get) for h, t in followed.items()} == {h: [t for t, _ in x] for h, x in lists.items()}
    assert rankings.read_changes(spark, str(tmp_path / "t"), key).where("change = 'leave'").count() > 0
