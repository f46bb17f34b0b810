from datetime import datetime

import pytest
from pyspark.sql import functions as F

from playtide.operators import clustering


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered"))
    # A third of all plays are one user's.
    user = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 97).cast("string")))
    plays = spark.range(30_000).select(
        user.alias("user_id"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                (F.xxhash64("id") % 1_000_000 + 1_000_000).cast("decimal(18,6)"))).alias("played_at"),
        F.col("id").alias("event_id"))
    plays = plays.unionByName(plays.limit(1).select(F.lit("u5").alias("user_id"), F.lit(None).cast("timestamp").alias("played_at"),
                                                    F.lit(-1).cast("bigint").alias("event_id"))).cache()
    clustering.write_clustered(plays, path, 64)
    return path, plays


def test_one_users_timeline_reads_few_files(spark, laid_out):
    path, plays = laid_out
    every = spark.read.parquet(f"{path}/plays").inputFiles()
    rows = clustering.read_timeline(spark, path, "u5")
    assert len(every) >= 50 and len(rows.inputFiles()) <= len(every) / 4
    wanted = [r.event_id for r in plays.where("user_id = 'u5'").orderBy(F.desc_nulls_last("played_at")).collect()]
    assert [r.event_id for r in rows.collect()] == wanted and wanted[-1] == -1
    scan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in scan and "EqualTo(user_id,u5)" in scan


def test_a_span_of_time_reads_few_files(spark, laid_out):
    path, plays = laid_out
    since, until = datetime(2024, 1, 10), datetime(2024, 1, 11)
    files = clustering.files_of(spark, path, since=since, until=until)
    assert 0 < len(files) <= len(spark.read.parquet(f"{path}/plays").inputFiles()) / 2
    rows = clustering.read_timeline(spark, path, "hot", since=since, until=until)
    day = plays.where((F.col("user_id") == "hot") & (F.col("played_at") >= F.lit(since)) & (F.col("played_at") < F.lit(until)))
    assert rows.count() == day.count() > 0
    assert len(rows.inputFiles()) <= len(files)


def test_a_hot_user_is_spread(spark, laid_out):
    path, _ = laid_out
    zones = spark.read.parquet(f"{path}/zones")
    assert zones.agg(F.max("plays")).first()[0] < 30_000 / 16 and zones.agg(F.sum("plays")).first()[0] == 30_001


def test_unknown_users_and_no_plays(spark, laid_out, tmp_path):
    path, plays = laid_out
    assert clustering.read_timeline(spark, path, "nobody").count() == 0
    clustering.write_clustered(plays.where("event_id < -5"), str(tmp_path), 4)
    assert clustering.read_timeline(spark, str(tmp_path), "u5").count() == 0


def test_bits_take_turns(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 0), (1023, 1023), (512, 1)], "a int, b int")
    keys = [r.k for r in rows.select(clustering.interleaved(F.col("a"), F.col("b")).alias("k")).collect()]
    assert keys == [0, 2, 1, 10, (1 << 20) - 1, (1 << 19) + 1]


def test_users_named_by_numbers(spark, tmp_path):
    plays = spark.range(500).select((F.col("id") % 9).alias("user_id"), F.timestamp_seconds("id").alias("played_at"))
    clustering.write_clustered(plays, str(tmp_path), 8)
    assert clustering.read_timeline(spark, str(tmp_path), 4).count() == plays.where("user_id = 4").count()
