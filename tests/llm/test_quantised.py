import math

import numpy as np
import pytest

from playtide.llm import queries, quantised

from .test_simhash import classes

SCHEMA = "vec_id bigint, embedding array<float>, label int, item bigint, key string, vec string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "k", "v")
                                  for i, v in rows], schema)


def good(vector):
    return vector is not None and len(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def by_hand(rows, threshold=0.95):
    """Row by row: id, links, smallest id reached."""
    units = [np.array(v, np.float32).astype(float) if good(v) else None for _, v in rows]
    units = [None if u is None else u / np.sqrt(u @ u) for u in units]
    linked = lambda a, b: (units[a] is not None and units[b] is not None and len(units[a]) == len(units[b])
                           and units[a] @ units[b] >= threshold)
    n = len(rows)
    links = [sum(linked(a, b) for b in range(n) if b != a) for a in range(n)]
    group = classes(list(range(n)), linked)
    least = {}
    for i, (name, _) in enumerate(rows):
        least[group[i]] = min((x for x in (least.get(group[i]), name) if x is not None), default=None)
    return sorted((str(name), links[i], str(least[group[i]])) for i, (name, _) in enumerate(rows))


def found_rows(found):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in found.collect())


def turned(rng, vector, cosine):
    """A vector at exactly that cosine."""
    vector = vector / np.linalg.norm(vector)
    side = rng.standard_normal(len(vector))
    side -= side @ vector * vector
    return cosine * vector + math.sqrt(1 - cosine ** 2) * side / np.linalg.norm(side)


EDGES = [(1, None), (2, []), (3, [0.0] * 8), (4, [None] + [1.0] * 7), (5, [float("nan")] * 8), (6, [float("inf")] + [1.0] * 7),
         (7, [1.0] * 8), (8, [2.0] * 8), (9, [1e30] * 8), (10, [1.0] * 8), (10, [1.0] * 8), (None, [1.0] * 8), (11, [1.0] * 9),
         (-3, [-1.0] * 8), (12, [1e-40] * 8), (13, [1.0] + [-0.0] * 7), (14, [1.0] + [0.0] * 7), (None, [0.0] * 8),
         (None, [1.0, -1.0] * 4), (15, [5.0]), (16, [2.0])]


@pytest.mark.parametrize("hot", [2, quantised.HOT])
def test_edges_against_brute_force(spark, hot):
    assert found_rows(quantised.near_vectors(frame(spark, EDGES), hot=hot)) == by_hand(EDGES)


def test_empty(spark):
    assert quantised.near_vectors(frame(spark, [])).collect() == []
    nothing = frame(spark, [(1, None), (2, [0.0])])
    assert found_rows(quantised.near_vectors(nothing)) == [("1", 0, "1"), ("2", 0, "2")]


def test_crowds_are_counted_exactly(spark, monkeypatch):
    monkeypatch.setattr(quantised, "TILE", 16)
    rng = np.random.default_rng(6)
    rows = []
    centre = rng.standard_normal(32)
    for near, count in ((0.998, 60), (0.975, 50), (0.95, 20), (0.9, 20)):  # from one tight core outwards
        rows += [turned(rng, centre, near) for _ in range(count)]
    rows += [turned(rng, turned(rng, centre, 0.93), 0.999) for _ in range(40)]  # a second crowd beside the first
    other = rng.standard_normal(32)
    rows += [turned(rng, other, rng.uniform(0.97, 0.99)) for _ in range(60)] + [other] * 30
    rows += list(rng.standard_normal((60, 32)))
    rows = [(i, list(v)) for i, v in enumerate(rows)]
    found = found_rows(quantised.near_vectors(frame(spark, rows), hot=10))
    wanted = by_hand(rows)
    missed = sum(w[1] - f[1] for f, w in zip(found, wanted))
    assert all(f[1] <= w[1] for f, w in zip(found, wanted)) and missed <= 0.005 * sum(w[1] for w in wanted)
    crowded = [(f, w) for f, w in zip(found, wanted) if w[1] >= 30]
    assert len(crowded) > 150 and sum(f == w for f, w in crowded) >= 0.99 * len(crowded)


@pytest.mark.parametrize("width", [16, 64, 300])
def test_recall_at_the_threshold(spark, width):
    """Pairs just above the threshold, the hardest ones, among vectors that link with nothing."""
    rng = np.random.default_rng(width)
    base = rng.standard_normal((1500, width)) * np.linspace(0.2, 2, width)
    pairs = [turned(rng, base[i], 0.9501) for i in range(600)]
    rows = [(i, list(v)) for i, v in enumerate([*base, *pairs])]
    found = {r.vec_id: r for r in quantised.near_vectors(frame(spark, rows)).collect()}
    units = np.array([v for _, v in rows], np.float32).astype(float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    close = units @ units.T >= 0.95
    np.fill_diagonal(close, False)
    wanted = close.sum(axis=1)
    got = np.array([found[i].n_links for i in range(len(rows))])
    assert (got <= wanted).all() and got.sum() >= 0.97 * wanted.sum()


def test_bits_are_balanced():
    rng = np.random.default_rng(1)
    sample = quantised.unit(rng.standard_normal((2000, 48)) * np.linspace(0.3, 3, 48))
    model = quantised.Quantiser(sample, 2000)
    values = model.rotated(sample)
    assert np.abs((values >= 0).mean(axis=0) - 0.5).max() < 0.05
    loss = lambda v: ((np.where(v >= 0, 1, -1) - v * math.sqrt(48)) ** 2).mean()
    turned_at_random = sample @ np.linalg.qr(rng.standard_normal((48, 48)))[0]
    assert loss(values[:, :48]) < loss(turned_at_random)
    bits = np.unpackbits(model.codes(values).view(np.uint8), axis=1, bitorder="little")
    assert (bits == (values >= 0)).all()


def test_survivors_keep_their_columns(spark):
    docs = frame(spark, EDGES)
    kept = quantised.keep_smallest(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.vec_id) for r in kept.collect()) == sorted(
        name for name, _, least in by_hand(EDGES) if name == "None" or name == least)


def test_query_on_given_vectors(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = queries.QUERIES["op12_quantised"](spark, sf)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert found_rows(found) == by_hand(rows)
