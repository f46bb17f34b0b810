import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from playtide.llm import warc

from .conftest import prose

LONG = "<html>" + "same page " * 30 + "</html>"
PAGES = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (5, "http://a/5", LONG), (3, None, "short"),
         (4, "http://a/4 ü\r\nX: y", "short"), (6, "http://a/6", None), (7, "http://a/7", ""), (None, "http://a/n", LONG),
         (8, "http://a/8", "WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n" + "\x1f�\x08" * 50 + "\r\n\r\n" * 40),
         (9, "http://a/9", "z" * 300_000), (9, "http://a/9", "z" * 300_000), (10, "", "\x00\x00" * 100)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "page_id bigint, url string, html string, digest string, first int")


def written(spark, tmp_path, rows=PAGES):
    warc.write(pages(spark, rows), f"{tmp_path}/warc")
    return warc.read(spark, f"{tmp_path}/warc")


def test_round_trip(spark, tmp_path):
    read = written(spark, tmp_path)
    assert warc.gaps(read).collect() == []
    rows = warc.records(read).collect()
    assert len(rows) == len(PAGES)
    by_id = {r.record_id: r for r in rows}
    html = {f"<urn:x-page:{i}>": h or "" for i, _, h in PAGES if i is not None}
    for name, row in by_id.items():
        if name and row.type == "response":
            assert bytes(row.payload).decode() == html[name]
        if name:
            assert row.payload_digest == "sha256:" + hashlib.sha256(html[name].encode()).hexdigest()
    kinds = {name: (r.type, r.refers_to) for name, r in by_id.items()}
    assert kinds["<urn:x-page:1>"] == ("response", None)
    assert kinds["<urn:x-page:2>"] == kinds["<urn:x-page:5>"] == kinds[None] == ("revisit", "<urn:x-page:1>")
    assert all(kinds[f"<urn:x-page:{i}>"][0] == "response" for i in (3, 4, 6, 7, 8, 9, 10))
    assert sum(r.record_id == "<urn:x-page:9>" and r.type == "response" for r in rows) == 2


def test_query(spark, tmp_path):
    from playtide.llm import queries
    rows = [r for r in PAGES if r[0] is not None]
    pages(spark, rows).select("page_id", "url", "html").write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.QUERIES["op1_warc"](spark, str(tmp_path)).collect()
    wanted = [(i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(),
               *(("revisit", 1) if i in (2, 5) else ("response", None))) for i, _, h in rows]
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in found))) == sorted(map(str, wanted))


def test_files_are_gzip_members(spark, tmp_path):
    warc.write(pages(spark).coalesce(1), f"{tmp_path}/warc")
    raw = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(f"{tmp_path}/warc").collect())
    assert gzip.decompress(raw).count(b"WARC-Type: ") == len(PAGES)


def test_empty(spark, tmp_path):
    read = written(spark, tmp_path, [])
    assert warc.records(read).collect() == [] and warc.gaps(read).collect() == []


@pytest.mark.parametrize("length", [0, 1, 20])
def test_members_end_with_zero(length):
    assert warc.member(b"x" * length)[-1] == 0


def test_long_members_get_an_empty_one():
    data = bytes((1 << 24) + 5)
    packed = warc.member(data)
    assert packed[-1] == 0 and gzip.decompress(packed) == data


def records_of(count, seed=1):
    return [warc.record(i, f"http://a/{i}", prose(seed * 100 + i).encode(), "0", None) for i in range(count)]


@pytest.mark.parametrize("pack", [warc.member, lambda data: data], ids=["members", "plain"])
def test_salvage_recovers_all_but_the_damaged(pack):
    parts = [pack(r) for r in records_of(12)]
    clean = b"".join(parts)
    assert [r[3]["warc-record-id"] for r in warc.salvage(clean)] == [f"<urn:x-page:{i}>" for i in range(12)]
    rng = random.Random(4)
    for _ in range(60):
        hit = rng.randrange(12)
        part = bytearray(parts[hit])
        where = rng.randrange(20, len(part) - 12)
        kind = rng.choice(["flip", "cut", "insert"])
        if kind == "flip":
            part[where] ^= 0xFF
        elif kind == "cut":
            del part[where:where + rng.randint(1, 10)]
        else:
            part[where:where] = bytes(rng.randrange(256) for _ in range(rng.randint(1, 30)))
        data = b"".join([*parts[:hit], bytes(part), *parts[hit + 1:]])
        found = list(warc.salvage(data))
        ids = [r[3]["warc-record-id"] for r in found if r[2] is None]
        others = [f"<urn:x-page:{i}>" for i in range(12) if i != hit]
        assert [i for i in ids if i in others] == others  # a plain record's own headers have no checksum
        spans = sorted((r[0], r[1]) for r in found)
        assert spans[0][0] == 0 and spans[-1][1] >= len(data) - 4
        gaps = [r for r in found if r[2]]
        if len(ids) == 11:
            start = sum(map(len, parts[:hit]))
            assert len(gaps) == 1 and gaps[0][0] == start and gaps[0][1] == start + len(part) and gaps[0][2]


def test_salvage_inside_a_member_of_many_records():
    parts = records_of(12)
    name = lambda rows: [int(r[3]["warc-record-id"][12:-1]) for r in rows if r[2] is None]
    start, stop = sum(map(len, parts[:5])), sum(map(len, parts[:6]))
    bad = parts[5][:-20] + b"#" + parts[5][-19:]  # its block digest differs
    packed = warc.member(b"".join([*parts[:5], bad, *parts[6:]]))
    found = list(warc.salvage(packed + warc.member(parts[0])))
    assert name(found) == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 0]
    assert [r[2] for r in found if r[2]] == [f"content {start} to {stop}: block digest differs"]
    whole = warc.member(b"".join(parts))
    cut = list(warc.salvage(whole[:len(whole) * 2 // 3]))
    assert name(cut) == list(range(len(name(cut)))) and 5 <= len(name(cut)) < 12
    assert any(r[2].startswith(f"content {sum(map(len, parts[:len(name(cut))]))} to") for r in cut if r[2])
    assert (0, len(whole) * 2 // 3, "member without an end") in [r[:3] for r in cut]
    broken = bytearray(whole)
    broken[-12] ^= 0xFF  # near the end of the stream
    broken = list(warc.salvage(bytes(broken) + warc.member(parts[0])))
    assert set(range(10)) <= set(name(broken)) and name(broken)[-1] == 0 and any(r[2] for r in broken)


def test_salvage_odd_input():
    assert list(warc.salvage(b"")) == []
    assert [(r[0], r[1]) for r in warc.salvage(b"no archive at all")] == [(0, 17)]
    one = warc.record(1, None, b"payload", "0", None)
    mixed = b"junk" + one + warc.member(one) + b"\x1f\x8b\x08 more junk" + one + one[:-30]
    kinds = [r[2] is None for r in warc.salvage(mixed)]
    assert kinds == [False, True, True, False, True, False]
    lying = one.replace(b"Content-Length: 8", b"Content-Length: 9")
    assert [r[2] is None for r in warc.salvage(lying + one)][-1] is True


def test_damaged_archives_in_spark(spark, tmp_path):
    parts = [warc.member(r) for r in records_of(30)]
    parts[7] = parts[7][:40] + parts[7][50:]
    folder = tmp_path / "damaged"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(b"".join(parts))
    read = warc.read(spark, str(folder)).cache()
    assert warc.records(read).count() == 29
    gap = warc.gaps(read).first()
    assert (gap.start, gap.stop) == (sum(map(len, parts[:7])), sum(map(len, parts[:8]))) and gap.reason
    assert warc.records(read).select(F.countDistinct("record_id")).first()[0] == 29


def test_damaged_headers_are_gaps():
    one, two = warc.record(1, "http://a/1", b"payload", "0", None), warc.record(2, "http://a/2", b"other", "0", None)
    for damaged in (one.replace(b"WARC-Record-ID", b"WARC\x00Record-ID"), one.replace(b"WARC-Record-ID", b"WARC-Recorf-ID"),
                    one.replace(b"x-page:1", b"x-page:7"), one.replace(b"http://a/1", b"http://a/9")):
        found = list(warc.salvage(damaged + two))
        assert [r[3].get("warc-record-id") for r in found if r[2] is None] == ["<urn:x-page:2>"]
        assert [(r[0], r[1]) for r in found if r[2]] == [(0, len(damaged))]


def foreign(number, block=b"x", drop=b""):
    lines = [b"WARC/1.1", b"WARC-Type: resource", b"WARC-Record-ID: <urn:f:%d>" % number, b"WARC-Date: 2020-01-01T00:00:00Z",
             b"Content-Length: %d" % len(block)]
    return b"\r\n".join(x for x in lines if not drop or not x.startswith(drop)) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_headers_without_a_digest_are_not_proven(spark, tmp_path):
    for needed in (b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"):
        found = list(warc.salvage(foreign(1, drop=needed) + foreign(2)))
        assert [r[3].get("warc-record-id") for r in found if r[2] is None] == ["<urn:f:2>"]
    (tmp_path / "mixed.warc").write_bytes(foreign(1) + warc.record(2, None, b"p", "0", None))
    assert sorted((r.record_id, r.proven) for r in warc.read(spark, f"{tmp_path}/mixed.warc").collect()) == [
        ("<urn:f:1>", False), ("<urn:x-page:2>", True)]


@pytest.mark.parametrize("where", [0.5, 1.0])
def test_records_of_a_stored_member_come_once(where):
    """A member without compression holds its version lines as they are."""
    import zlib
    parts = records_of(5)
    engine = zlib.compressobj(0, zlib.DEFLATED, 31)
    packed = bytearray(engine.compress(b"".join(parts)) + engine.flush())
    place = len(packed) - 6 if where == 1 else packed.index(b"Content-Length", int(len(packed) * where))
    packed[place] ^= 0xFF  # in the checksum, or within a record
    found = list(warc.salvage(bytes(packed) + warc.member(parts[0])))
    names = [int(r[3]["warc-record-id"][12:-1]) for r in found if r[2] is None]
    hit = [] if where == 1 else [i for i in range(5) if i not in names]
    assert len(hit) == (where < 1) and names == [i for i in range(5) if i not in hit] + [0]
    assert all(r[0] < r[1] <= len(packed) for r in found[:-1])
    inside = [r for r in found if r[2] is None and r[0] == 0]
    assert all(r[1] > len(packed) - 16 for r in inside)


def test_revisits_of_a_lost_response_stay(spark, tmp_path, monkeypatch):
    from playtide.llm import queries
    pages(spark, [(1, "u", LONG), (2, "u", LONG)]).select("page_id", "url", "html").write.parquet(f"{tmp_path}/pages.parquet")
    whole = warc.read
    monkeypatch.setattr(warc, "read", lambda *a: whole(*a).where("type = 'revisit'"))
    row, = queries.QUERIES["op1_warc"](spark, str(tmp_path)).collect()
    assert (row.page_id, row.payload_bytes, row.record_type, row.refers_to) == (2, None, "revisit", 1)
    assert row.payload_digest == hashlib.sha256(LONG.encode()).hexdigest()
