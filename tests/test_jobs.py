import json

from playtide import jobs
from playtide.streaming import ingest as flow
from tests.test_plays import PAYLOADS, artist, track


def test_publish_to_ingest(spark, tmp_path):
    for name, documents in {
        "recent": PAYLOADS,
        "catalog": [{"artist_id": "a1", "market": "DE", "tracks": [track("x", "X"), track("y", "Y")]}],
        "artists": [artist("a1", "One")],
    }.items():
        (tmp_path / name).mkdir()
        for i, document in enumerate(documents):
            (tmp_path / name / f"{i}.json").write_text(json.dumps(document), encoding="utf-8")
    recent, topic = str(tmp_path / "recent"), str(tmp_path / "messages")
    jobs.publish(spark, recent, "plays", path=topic)
    documents = jobs.top_tracks(spark, recent, str(tmp_path / "catalog"), str(tmp_path / "artists"))
    jobs.files.write_messages(jobs.files.topic_messages(documents, "tops"), topic)
    for _ in range(2):
        jobs.ingest(spark, str(tmp_path / "out"), str(tmp_path / "progress"), "plays", "tops", path=topic, once=True)
    plays = flow.read_table(spark, flow.play_event_route("plays"), str(tmp_path / "out"))
    # Without a play time, a track or a track id an event has no key.
    assert {(r["user_id"], r["track_id"]) for r in plays.where("user_id = 'u1'").collect()} == {
        ("u1", "t2"), ("u1", "t1")}
    assert plays.where("user_id = 'u4'").count() == 60
    assert plays.where("user_id = 'u4'").first()["market_used"] == "AT"
    tops = flow.read_table(spark, flow.top_tracks_route("tops"), str(tmp_path / "out")).collect()
    assert [(r["user_id"], r["market"], r["artist_name"], [t["track_name"] for t in r["tracks"]]) for r in tops] == [
        ("u1", "DE", "One", ["X", "Y"])]
    boards = jobs.leaderboards(spark, recent)
    assert boards["albums"].count() == 1 and boards["tracks"].where("user_id = 'u4'").count() == 10


def test_overlapping_payloads_of_one_user(spark, tmp_path):
    old = [{"played_at": f"2024-01-0{d}T10:00:00Z", "track": track(f"t{d}", artists=[artist("a1", "One")])} for d in (2, 1)]
    new = [{"played_at": "2024-01-03T10:00:00Z", "track": track("t3", artists=[artist("a1", "One")])}, *old[:1]]
    documents = {"recent": [{"user_id": "u", "country": "DE", "items": old}, {"user_id": "u", "country": "AT", "items": new}],
                 "catalog": [{"artist_id": "a1", "market": "AT", "tracks": [track("x", "X")]}],
                 "artists": [artist("a1", "One")]}
    for name, rows in documents.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "all.json").write_text("".join(json.dumps(row) + "\n" for row in rows), encoding="utf-8")
    board = jobs.leaderboards(spark, str(tmp_path / "recent"), multi_line=False)["tracks"].orderBy("rank").collect()
    assert [(r["track_id"], r["plays"]) for r in board] == [("t3", 1), ("t2", 1), ("t1", 1)]
    tops = jobs.top_tracks(spark, str(tmp_path / "recent"), str(tmp_path / "catalog"), str(tmp_path / "artists"),
                           multi_line=False)
    assert [(r["user_id"], r["market"]) for r in tops.collect()] == [("u", "AT")]
    jobs.main(["leaderboards", "--payloads", str(tmp_path / "recent"), "--output", str(tmp_path / "boards"), "--lines"])
    assert spark.read.parquet(str(tmp_path / "boards" / "tracks")).count() == 3
