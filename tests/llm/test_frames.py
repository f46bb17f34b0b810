import pyarrow as pa

from playtide.llm import frames, queries


def test_slices_keep_all_rows_and_bound_bytes():
    texts = ["a" * n for n in (0, 10, 300, 5, 5, 90, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    cut = list(frames.slices([batch, batch.slice(0, 0)], "text", limit=100))
    assert [t for part in cut for t in part["text"].to_pylist()] == texts
    assert all(sum(len(t or "") for t in part["text"].to_pylist()[:-1]) < 100 for part in cut)


def test_drawn_rows_are_bounded_and_repeatable(spark):
    rows = spark.range(5000)
    first = {r.id for r in frames.drawn_rows(rows, 5000, 100, "id").collect()}
    again = {r.id for r in frames.drawn_rows(rows.repartition(7), 5000, 100, "id").collect()}
    assert first == again and len(first) == 100
    assert frames.drawn_rows(rows, 5000, 9000, "id").count() == 5000
    assert frames.drawn_rows(rows.limit(0), 0, 10, "id").count() == 0


def test_one_query_per_operator():
    numbers = sorted(int(name.split("_")[0][2:]) for name in queries.QUERIES)
    assert numbers == list(range(1, 11))
    assert set(queries.SQL) <= set(queries.QUERIES)
