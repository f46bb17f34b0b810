import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.operators import stories
from playtide.streaming.live import LiveTable
from playtide.streaming.rollups import PlayRollup

ITEM, USER = T.StructField("track", T.StringType()), T.StructField("user_id", T.LongType())


def frame(spark, rows):
    return spark.createDataFrame(rows, "track string, at string, user_id bigint").select(
        "track", F.col("at").cast("timestamp").alias("played_at"), "user_id")


def plays_of(seed, count):
    rng = random.Random(seed)
    return [(f"t{rng.randrange(3)}", f"2024-01-{rng.randrange(1, 25):02d} 10:00:00", rng.randrange(40)) for _ in range(count)]


def state(spark, rollup):
    return sorted((r.track, r.day, r.plays, round(r.moving_average, 9)) for r in rollup.daily_plays(spark).collect())


def test_late_and_repeated_batches_give_the_full_query(spark, tmp_path, monkeypatch):
    rollup = PlayRollup(str(tmp_path / "r"), ITEM, USER)
    batches = [plays_of(1, 60), plays_of(2, 60), [("t0", "2024-01-02 00:00:00", 1)], [], plays_of(3, 30)]
    for number, batch in enumerate(batches[:3]):
        rollup.add(frame(spark, batch), "w", number)
    rollup.add(frame(spark, batches[1]), "w", 1)
    # A batch that is lost between two tables is given again.
    refresh = PlayRollup._refresh_averages
    monkeypatch.setattr(PlayRollup, "_refresh_averages", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        rollup.add(frame(spark, batches[4]), "w", 4)
    monkeypatch.setattr(PlayRollup, "_refresh_averages", refresh)
    rollup.add(frame(spark, batches[4]), "w", 4)
    every = [p for b in batches for p in b] + [(None, "2024-01-01 00:00:00", 1), ("t0", None, 1)]
    full = stories.daily_plays(frame(spark, every[:-2]), "track")
    assert state(spark, rollup) == sorted((r.track, r.day, r.plays, round(r.moving_average, 9)) for r in full.collect())
    exact = defaultdict(set)
    for track, at, user in every[:-2]:
        exact[(track, at[:7])].add(user)
    month = F.date_format("day", "yyyy-MM")
    assert {(r.track, r.period): r.listeners for r in rollup.listener_counts(spark, month).collect()} == {
        k: len(v) for k, v in exact.items()}


def test_only_what_rests_on_touched_days_is_made_anew(spark, tmp_path, monkeypatch):
    rollup = PlayRollup(str(tmp_path / "r"), ITEM, USER, days=3)
    rollup.add(frame(spark, [("a", f"2024-01-{d:02d} 01:00:00", d) for d in range(1, 21)]), "w", 0)
    written = []
    write = LiveTable.write
    monkeypatch.setattr(LiveTable, "write", lambda self, rows, *a: (
        written.append((self.path.rsplit("/", 1)[1], sorted(r.day.day for r in rows.collect()))), write(self, rows, *a))[1])
    rollup.add(frame(spark, [("a", "2024-01-05 02:00:00", 99), ("a", "2024-01-20 02:00:00", 99)]), "w", 1)
    assert written == [("daily", [5, 20]), ("listeners", [5, 20]), ("averages", [5, 6, 7, 20])]
    assert [r[3] for r in state(spark, rollup) if r[1].day in (4, 5, 7, 8, 20)] == [1, round(4 / 3, 9), round(4 / 3, 9), 1, round(4 / 3, 9)]


def test_estimates_keep_their_error_over_many_days(spark, tmp_path):
    rollup = PlayRollup(str(tmp_path / "r"), ITEM, USER)
    for number in range(3):
        rows = spark.range(40_000).select(
            F.lit("a").alias("track"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int"))
            .cast("timestamp").alias("played_at"), (F.col("id") + 20_000 * number).alias("user_id"))
        rollup.add(rows, "w", number)
    exact = rollup.listener_counts(spark, F.lit("all")).first().listeners
    estimate = rollup.listener_estimates(spark, F.lit("all")).first().listeners
    assert exact == 80_000 and abs(estimate - exact) <= 0.03 * exact
