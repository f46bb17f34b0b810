import json

import pytest
from pyspark.sql import functions as F

from playtide.operators import playlists, tables
from playtide.schemas import GENRES
from playtide.sources import files, payloads


def item(i, name="T", artists=()):
    return {"track": {"id": i, "name": name, "artists": [{"id": a, "name": a} for a in artists]}}


PLAYLISTS = [
    {"playlist_id": "p1", "playlist_name": "One", "owner_id": "o", "items": [
        item("a", "First", ["x", "", "y"]), {"track": None}, item("b"), item("a", "Again"), item(None), item("c", None)]},
    {"playlist_id": "p2", "playlist_name": "Two", "owner_id": "o", "items": [item("a"), item("z")]},
    {"playlist_id": "p3", "playlist_name": "Empty", "owner_id": None, "items": []},
]


@pytest.fixture()
def items(spark, tmp_path):
    for p in PLAYLISTS:
        (tmp_path / f"{p['playlist_id']}.json").write_text(json.dumps(p))
    return payloads.playlist_items(payloads.read_payloads(spark, str(tmp_path), "playlist_tracks"))


def test_playlist_tracks(items):
    got = {(r["playlist_id"], r["track_id"]): r for r in playlists.playlist_tracks(items).collect()}
    assert set(got) == {("p1", "a"), ("p1", "b"), ("p2", "a"), ("p2", "z")}
    assert got[("p1", "a")]["track_name"] == "First" and got[("p1", "a")]["artists"] == "x, y"
    # The limit counts raw entries: the third one is the second track.
    assert playlists.playlist_tracks(items, 2).where("playlist_id = 'p1'").count() == 1


def test_playlist_table(items):
    rows = playlists.playlist_table(items).where("playlist_id = 'p1'").orderBy("position").collect()
    assert [r["_id"] for r in rows] == ["ap1", None, "bp1", "ap1", None, "cp1"]
    assert "track" not in rows[0]


def test_user_playlists_and_columns(spark, tmp_path):
    document = {"items": [{"id": "p", "name": "N", "owner": {"id": "o"}, "tracks": {"href": "h"}}]}
    (tmp_path / "u.json").write_text(json.dumps(document))
    rows = payloads.user_playlists(payloads.read_payloads(spark, str(tmp_path), "user_playlists"))
    assert tuple(rows.first()) == ("p", "N", "o", "h")
    assert tables.columns_from(rows, "owner_id").columns == ["owner_id", "href"]
    wide = tables.project(rows, ["playlist_id", "loudness"], rename={"playlist_id": "_id"})
    assert tuple(wide.first()) == ("p", None) and wide.columns == ["_id", "loudness"]
    assert [r[0] for r in tables.last_rows(spark.range(9), ["id"]).collect()] == [8, 7, 6, 5, 4]


def test_audio_profile_takes_features_all_or_none(spark):
    rows = spark.createDataFrame(
        [("A", 0.2, 10.0), ("A", 0.4, None), ("B", 0.1, 1.0), ("C", None, 5.0), (None, 0.5, 5.0)],
        "playlist_name string, danceability double, tempo double")
    got = playlists.playlist_audio_profile(rows, columns=["danceability", "tempo"])
    assert [tuple(r) for r in got.collect()] == [("B", 0.1, 1.0), ("A", 0.2, 10.0), ("C", None, None)]


SEARCHES = [
    {"query": "pop", "playlists": {"items": [None, {"id": "", "name": "x"}, {"id": "p1", "name": "P"}]}},
    {"query": "edm", "playlists": {"items": [{"id": "p2", "name": "E"}, {"id": "p1", "name": "P"}]}},
    {"query": "best of trance", "playlists": {"items": [{"id": "p2", "name": "T"}]}},
    {"query": "trance", "playlists": {"items": []}},
    {"query": "dubstep", "playlists": None},
]


def test_compare_genres(spark, tmp_path, items):
    (tmp_path / "s").mkdir()
    for i, s in enumerate(SEARCHES):
        (tmp_path / "s" / f"{i}.json").write_text(json.dumps(s))
    searches = payloads.search_results(payloads.read_payloads(spark, str(tmp_path / "s"), "playlist_search"))
    genres = spark.createDataFrame([("pop",), ("edm",), ("trance",), ("dubstep",)], "genre string")
    analysis = spark.createDataFrame([("a", 0.5), ("b", None), ("z", 0.1)], "track_id string, danceability double")
    got = playlists.compare_genres(genres, searches, items, analysis)
    assert [(r[0], r[1] and round(r[1], 6), r[2]) for r in got.collect()] == [
        ("pop", 0.5, 1), ("edm", 0.3, 2), ("dubstep", None, 0), ("trance", None, 0)]
    kept = tables.drop_missing(got, ["avg_danceability"])
    assert kept.count() == 2
    picked = playlists.pick_playlists(genres, searches, ["{} official", "best of {}", "{} mix"])
    assert {tuple(r) for r in picked.select("genre", "playlist_id").collect()} == {
        ("pop", "p1"), ("edm", "p2"), ("trance", "p2")}
    named = playlists.genre_tracks(genres, searches, items)
    assert {r["genre"] for r in named.collect()} == {"pop", "edm"}


def test_genre_list(spark):
    rows = playlists.genre_list(spark).orderBy("place").collect()
    assert [r["genre"] for r in rows] == GENRES and len(rows) == 12


def test_stack_rows(spark):
    left = spark.createDataFrame([(1, "a")], "x int, y string")
    right = spark.createDataFrame([("b", 2.0)], "y string, z double")
    assert [tuple(r) for r in tables.stack_rows([left, right]).collect()] == [(1, "a", None), (None, "b", 2.0)]


def test_catalogue_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        ",track_id,track_genre,tempo,artists\n0,t1,pop,NaN,\"A \"\"x\"\", B\"\n1,t2,,120.5,é\n", encoding="utf-8")
    rows = files.read_catalogue(spark, str(tmp_path / "c.csv"), spark.createDataFrame(
        [], "track_id string, track_genre string, tempo double, artists string").schema)
    assert [tuple(r) for r in rows.collect()] == [("t1", "pop", None, 'A "x", B'), ("t2", None, 120.5, "é")]


def test_records_and_column_json(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"a": 1, "b": null},\n {"a": 2, "b": "x"}]')
    rows = files.read_records(spark, str(tmp_path / "r.json"), "a int, b string")
    assert [tuple(r) for r in rows.orderBy("a").collect()] == [(1, None), (2, "x")]
    files.write_records(rows, str(tmp_path / "out"))
    text = "".join(f.read_text() for f in (tmp_path / "out").glob("part*"))
    assert '{"a":1,"b":null}' in text
    files.write_column_json(rows.withColumn("n", F.col("a") - 1), str(tmp_path / "cols"), "n")
    back = files.read_column_json(spark, str(tmp_path / "cols"), {"a": "int", "b": "string"})
    assert [tuple(r) for r in back.orderBy("row_id").collect()] == [(0, 1, None), (1, 2, "x")]
    files.write_column_json(rows.withColumn("n", F.col("a") - 1), str(tmp_path / "many"), "n", rows_per_document=1)
    many = files.read_column_json(spark, str(tmp_path / "many"), {"a": "int", "b": "string"})
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, back.collect()))
