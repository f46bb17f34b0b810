import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from playtide.llm import quality, toxicity

from .conftest import EDGES, prose


def toxic_rows(count, seed, stem):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        words = prose(seed * 10_000 + i, rng.randint(20, 200)).split(" ")
        label = i % 2
        if label:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), stem + rng.choice(["er", "ish", "ed", "on", "an", "."]))
        rows.append((" ".join(words), label))
    return rows


@pytest.fixture(scope="module")
def network():
    return toxicity.train(toxic_rows(300, 1, "grumpf"), steps=120)


def test_held_out_accuracy(network):
    rows = toxic_rows(200, 2, "grumpf")
    slope, offset = network.scale
    scores = toxicity.sigmoid(slope * toxicity.text_scores(network, [t for t, _ in rows], toxicity.Features(network)) + offset)
    assert np.mean((scores >= 0.7) == np.array([y for _, y in rows])) >= 0.95


def test_a_word_in_any_window_counts(network):
    long = prose(77, 3000).split(" ")
    memory = toxicity.Features(network)
    clean = toxicity.text_scores(network, [" ".join(long)], memory)[0]
    for place in (0, 900, 1790, len(long)):
        spoilt = " ".join([*long[:place], "grumpfer grumpfed", *long[place:]])
        assert toxicity.text_scores(network, [spoilt], memory)[0] > clean + 1


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network({}, {})
    net.weights = {name: value.astype(np.float64) for name, value in net.weights.items()}
    x = rng.standard_normal((6, 9, toxicity.FEATURES))
    there = (np.arange(9) < np.array([9, 4, 1, 7, 9, 2])[:, None]).astype(float)
    y = np.array([0, 1, 1, 0, 1, 0])

    def loss():
        p = toxicity.sigmoid(net.run(x, there).astype(np.float64))
        return -np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))

    found = net.gradients(x, there, y)
    for name, grad in found.items():
        flat, g = net.weights[name].reshape(-1), grad.reshape(-1)
        for i in rng.choice(len(flat), min(4, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-3 - g[i]) < 2e-4, name


@pytest.mark.parametrize("count", [0, 1, 47, 48, 49, 80, 81, 500])
def test_windows_cover_every_word(count):
    cut = toxicity.windows(np.arange(1, count + 1, dtype=np.int32))
    assert set(cut.ravel().tolist()) - {0} == set(range(1, count + 1))
    assert len(cut) == 1 or cut[-1, -toxicity.STEP:].max() > 0
    for a, b in zip(cut, cut[1:]):
        assert len(np.intersect1d(a, b)) >= toxicity.WINDOW - toxicity.STEP


def test_toxicity_in_spark(documents, network):
    scored = toxicity.score(documents(EDGES), network).collect()
    assert len(scored) == len(EDGES) and all(0 <= r.score <= 1 for r in scored)
    same = [r.score for r in scored if r.text == "same text"]
    assert max(same) - min(same) < 1e-6
    assert toxicity.score(documents([]), network).collect() == []


def test_toxicity_without_labels(spark, documents):
    docs = documents([(i, prose(i)) for i in range(5)])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    one = spark.createDataFrame([(0, 1), (1, 1), (2, None), (None, 0)], "doc_id bigint, toxic int")
    rows = toxicity.training_rows(docs, none, "toxic", F.lit(True))
    assert toxicity.train(*rows) == 0.0
    rows = toxicity.training_rows(docs, one, "toxic", F.lit(True))
    assert len(rows[0]) == 2 and rows[1] == 1.0 and toxicity.train(*rows) == 1.0
    assert {r.score for r in toxicity.score(docs, 1.0).collect()} == {1.0}


def junk(seed):
    rng = random.Random(seed)
    return " ".join(w.upper() + rng.choice(["!!", "$$$", "###"]) for w in prose(seed).split(" "))


def test_quality_held_out(spark, documents):
    rows = [(i, junk(i) if i % 3 == 0 else prose(i)) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(300)] + [(None, 1), (5000, 0), (3, None)],
                                   "doc_id bigint, quality int")
    described = quality.with_statistics(documents(rows + EDGES).repartition(5))
    model = quality.fit(quality.training_rows(described, labels, "quality", F.col("id") % 2 == 0))
    scored = quality.score(described, model).collect()
    assert len(scored) == len(rows) + len(EDGES) and all(0 <= r.score <= 1 for r in scored)
    names = dict(rows)
    held = [r for r in scored if r.doc_id in names and r.doc_id % 2 and r.text == names[r.doc_id]]
    assert np.mean([(r.score >= 0.3) == (r.doc_id % 3 != 0) for r in held]) >= 0.97


def test_sums_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [([float(v) for v in rng.standard_normal(quality.STATISTICS)], float(i % 2)) for i in range(400)]
    frame = spark.createDataFrame(rows, "statistics array<double>, label double")
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    one, many = quality.fit(frame.coalesce(1)), quality.fit(frame.repartition(150))
    assert np.allclose(one.ridge(x), many.ridge(x), atol=1e-8)
    z = quality.fourier((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-3))
    penalty = np.diag(np.r_[np.full(quality.FEATURES, quality.RIDGE * 400), 1e-9 * 400])
    assert np.allclose(one.weights, np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)


def test_fourier_features_approximate_the_kernel(monkeypatch):
    monkeypatch.setattr(quality, "FEATURES", 20_000)
    x = np.random.default_rng(2).standard_normal((20, quality.STATISTICS))
    z = quality.fourier(x)[:, :-1]
    apart = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-apart / (2 * quality.WIDTH ** 2))).max() < 0.05


def test_isotonic_is_the_closest_rising_curve():
    rng = np.random.default_rng(3)
    score, weight = np.arange(30.0), rng.integers(1, 9, 30).astype(float)
    hits = rng.uniform(0, 1, 30) * weight
    edges, levels = quality.isotonic(score, weight, hits)
    assert (np.diff(levels) > 0).all()
    fitted = levels[np.searchsorted(edges, score, "right") - 1]
    rate = hits / weight  # max-min formula of isotonic regression
    for i in range(30):
        best = max(min(hits[a:b + 1].sum() / weight[a:b + 1].sum() for b in range(i, 30)) for a in range(i + 1))
        assert fitted[i] == pytest.approx(best), rate


def test_quality_without_labels(spark, documents):
    described = quality.with_statistics(documents(EDGES))
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.fit(quality.training_rows(described, none, "quality", F.lit(True))) is None
    assert {r.score for r in quality.score(described, None).collect()} == {0.0}
    ones = spark.createDataFrame([(1, 1), (4, 1)], "doc_id bigint, quality int")
    model = quality.fit(quality.training_rows(described, ones, "quality", F.lit(True)))
    assert {r.score for r in quality.score(described, model).collect()} == {1.0}
    assert quality.with_statistics(documents([])).collect() == []


def test_training_rows_are_one_per_id_and_take_long_texts(spark, documents):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(i, prose(i)) for i in range(20)] + [(7, f"hot {i}") for i in range(300)] + [(100, long), (None, "lost")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(7, 1), (100, 1), (None, 1), (999, 0)],
                                   "doc_id bigint, toxic int")
    found, _ = toxicity.training_rows(documents(rows), labels, "toxic", F.lit(True))
    again, _ = toxicity.training_rows(documents(rows[::-1]).repartition(7), labels, "toxic", F.lit(True))
    assert len(found) == 21 and sorted(found) == sorted(again)
    excerpt, = [t for t, _ in found if len(t) > 5000]
    parts = excerpt.split("\n")
    assert len(excerpt) <= toxicity.SAMPLE_CHARS + 3 and len(parts) == toxicity.EXCERPTS and all(p in long for p in parts)


def test_tokens_without_blanks_are_cut():
    token = "".join(chr(97 + i % 26) for i in range(1_000_000))
    cut = toxicity.tokens(token + " end")
    assert max(map(len, cut)) <= toxicity.LONG_WORD and cut[-1] == "end" and len(cut) < 20_000
    joined = cut[0] + "".join(t[toxicity.LAP:] for t in cut[1:-1])
    assert joined == token and toxicity.tokens(None) == [] and toxicity.tokens("a bc") == ["a", "bc"]
    assert toxicity.tokens("y" * 64) == ["y" * 64] and len(toxicity.tokens("y" * 65)) == 2
