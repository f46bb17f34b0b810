from pyspark.sql import functions as F

from playtide import functions as P
from playtide.sources.payloads import analysis_features


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_ms_to_mmss(spark):
    texts = column(spark, [0, None, 999, 1000, 61_500, 123 * 60_000 + 4_000], "bigint", P.ms_to_mmss("v"))
    assert texts == ["00:00", "00:00", "00:00", "00:01", "01:01", "123:04"]
    assert column(spark, [None, 2999], "bigint", P.seconds("v")) == [0, 2]


def test_present(spark):
    assert column(spark, ["", None, " ", "a"], "string", P.present("v")) == [False, False, True, True]


def test_join_names(spark):
    kind = "array<struct<id:string,name:string>>"
    people = [[("1", "A"), ("2", None), ("3", "")], [], None]
    assert column(spark, people, kind, P.join_names("v")) == ["A, ?, ", "", ""]
    assert column(spark, people, kind, P.join_present_names("v")) == ["A", "", ""]
    assert column(spark, [[("", "A"), ("2", "B"), (None, "C")], None], kind,
                  P.present_values("v", "id")) == [["2"], []]


def test_pick_keeps_zero(spark):
    kind = "struct<tempo:double,audio_features:struct<tempo:double>>"
    values = [(0.0, (5.0,)), (None, (5.0,)), (None, None)]
    assert column(spark, values, kind, P.pick("v", "tempo")) == [0.0, 5.0, None]


def test_market(spark):
    rows = spark.createDataFrame([(" RO ", "DE"), ("", "DE"), (None, ""), ("  ", None)], "o string, c string")
    assert [r[0] for r in rows.select(P.market_used("o", "c")).collect()] == ["RO", "DE", "AT", "AT"]


def test_numbers(spark):
    assert column(spark, ["12", None, "x", ""], "string", P.int_or_zero("v")) == [12, 0, 0, 0]
    texts = ['{"d":0.5}', '{"d":"0.5"}', '{"d":3}', '{"d":true}', '{"d":null}', "{}", "bad", None]
    assert column(spark, texts, "string", P.numeric_or_null("v", "$.d")) == [
        0.5, None, 3.0, 1.0, None, None, None, None]


def test_composite_key(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", None), (None, "b")], "x string, y string")
    assert [r[0] for r in rows.select(P.composite_key("x", "y")).collect()] == ["ab", None, None]


def test_utc_now_iso(spark):
    at = F.to_timestamp_ltz(F.lit("2024-03-01T12:00:00.25+02:00"))
    assert spark.range(1).select(P.utc_now_iso(at)).first()[0] == "2024-03-01T10:00:00.250000+00:00"


def test_nan_to_null(spark):
    rows = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, y int")
    assert [tuple(r) for r in P.nan_to_null(rows).orderBy("y").collect()] == [(None, 1), (2.0, 2)]


def test_camelot(spark):
    rows = spark.createDataFrame([(0, 1), (9, 0), (7, 1), (11, 1), (4, 0), (8, 0)], "key int, mode int")
    assert [r[0] for r in rows.select(P.camelot_code("key", "mode")).collect()] == [8, 8, 9, 1, 9, 1]


def test_safe_corr(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 2.0, 5.0), ("a", 2.0, 4.0, 5.0), ("a", 3.0, 5.0, 5.0), ("a", None, 9.0, 5.0),
         ("b", 1.0, 1.0, 1.0), ("c", None, None, None),
         ("d", 1.0, 1.0, 0.0), ("d", 1.0, -1.0, 0.0), ("d", -1.0, 1.0, 0.0), ("d", -1.0, -1.0, 0.0)],
        "g string, x double, y double, k double")
    got = {r[0]: r[1:] for r in rows.groupBy("g").agg(
        P.safe_corr("x", "y"), P.safe_corr("y", "x"), P.safe_corr("x", "k"), P.safe_corr("k", "x")).collect()}
    assert abs(got["a"][0] - 0.9819805060619659) < 1e-12 and abs(got["a"][1] - got["a"][0]) < 1e-12
    assert got["a"][2:] == (None, None)
    assert got["b"] == got["c"] == (None, None, None, None)
    assert got["d"] == (0.0, 0.0, None, None)


def test_analysis_features(spark):
    texts = ['{"danceability":0.1,"audio_features":{"danceability":0.9}}',
             '{"danceability":0,"audio_features":{"danceability":0.9}}',
             '{"danceability":null,"audio_features":{"danceability":0.9}}',
             '{"danceability":"0.4","audio_features":{"danceability":0.9}}',
             '{"audio_features":null}', "[1]", "oops", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "track_id int, analysis string")
    got = analysis_features(rows).orderBy("track_id")
    assert [r["danceability"] for r in got.collect()] == [0.1, 0.0, 0.9, None, None, None, None, None]
    assert got.columns == ["track_id", "danceability", "energy", "tempo", "key", "mode", "valence"]
