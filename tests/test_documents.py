import json
import random

import pytest

from pyspark.sql import functions as F

from playtide import session
from playtide.sources import documents

SCHEMA = "id bigint, name string, tags array<string>, inner struct<a: int, b: string>"
ODD = ['plain', 'quote " inside', 'back\\slash', 'brace } and { and ]', '\\" both', 'ümläut 中文', 'tab\tline\nend', '', '}{"', '"}', '\\\\']


def record(rng, i):
    return {"id": i, "name": rng.choice(ODD) * rng.randint(1, 4), "tags": [rng.choice(ODD) for _ in range(rng.randint(0, 3))],
            "inner": {"a": i % 7, "b": rng.choice(ODD)}}


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of a few hundred bytes, so that records, strings and escapes lie across them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "300b")
    spark.conf.set(names[1], "1b")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_one_document_is_read_by_many_tasks(spark, tmp_path, small_ranges, indent, ascii_only):
    rng = random.Random(4)
    wanted = [record(rng, i) for i in range(60)]
    (tmp_path / "one.json").write_text(json.dumps(wanted, indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    (tmp_path / "two.json").write_text(json.dumps([{"id": 1000, "name": None, "extra": {"x": [{"y": "}"}]}}]), encoding="utf-8")
    pieces = documents._pieces(spark, str(tmp_path))
    assert pieces.select("file", "block").distinct().count() > 20
    got = {r.id: json.loads(json.dumps(r.asDict(recursive=True)))
           for r in documents.read_array_records(spark, str(tmp_path), SCHEMA).collect()}
    assert got.pop(1000) == {"id": 1000, "name": None, "tags": None, "inner": None}
    assert [got[i] for i in range(60)] == wanted and len(got) == 60


def test_numbers_follow_the_document(spark, tmp_path, small_ranges):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "name": "x" * (i % 50)} for i in range(100)]))
    rows = documents.record_texts(spark, str(tmp_path)).orderBy("number").collect()
    assert [json.loads(r.record)["id"] for r in rows] == list(range(100))


@pytest.mark.parametrize("text,ids", [
    ("[]", []), ("", []), ("{}", [None]), ('{"id": 1}', [1]), (' [ {"id": 1} , {"id": 2} ] \n', [1, 2]),
    ('[1, "a } {", null, {"id": 3}, "tail"]', [3]), ('{"id": 1}\n{"id": 2}\n', [1, 2]), ('[{"id": 1}, {"id": ', [1, None]),
    ('[{"id": "no number"}, {"id": 2, "inner": {"a": 1}}]', [None, 2])])
def test_other_documents(spark, tmp_path, text, ids):
    (tmp_path / "a.json").write_text(text)
    got = [r.id for r in documents.read_array_records(spark, str(tmp_path), SCHEMA).collect()]
    assert sorted(got, key=str) == sorted(ids, key=str)


def test_tasks_hold_a_bounded_part_of_one_byte_range(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100, raising=False)
    monkeypatch.setattr(documents, "_RUN_BITS", 3, raising=False)
    rng = random.Random(5)
    wanted = [record(rng, i) for i in range(1500)]
    (tmp_path / "one.json").write_text(json.dumps(wanted), encoding="utf-8")
    texts = documents.record_texts(spark, str(tmp_path)).withColumn("part", F.spark_partition_id()).collect()
    assert [json.loads(r.record) for r in sorted(texts, key=lambda r: r.number)] == wanted
    sizes = [sum(r.part == part for r in texts) for part in {r.part for r in texts}]
    assert max(sizes) < 300 and len(sizes) > 10
