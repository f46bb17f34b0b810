import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from playtide.llm import attention_lm

from .conftest import EDGES, prose

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(autouse=True)
def few_steps(monkeypatch):
    monkeypatch.setattr(attention_lm, "STEPS", 20)


@pytest.fixture(scope="module")
def marks():
    return attention_lm.ids_for(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def model(marks):
    texts = [[i for w in attention_lm.words(prose(n)) for i in marks.of_word(w)] for n in range(60)]
    counts = np.bincount(np.concatenate(texts), minlength=marks.size)
    return attention_lm.train(texts, counts, marks, steps=60)


def test_windows_score_each_id_once(marks):
    rng = np.random.default_rng(1)
    lengths = np.array([1, 15, 16, 17, 40, 3])
    ids = rng.integers(0, 50_000, lengths.sum()).astype(np.int32)
    inputs, targets = attention_lm.windows(ids, lengths, marks.start, marks.none)
    assert targets[targets >= 0].tolist() == ids.tolist()
    row = 0
    for text in np.split(ids, np.cumsum(lengths)[:-1]):
        line = [marks.none] * attention_lm.CONTEXT + [marks.start, *text[:-1]]
        for start in range(0, len(text), attention_lm.SCORED):
            wanted = line[start:start + attention_lm.LENGTH]
            assert inputs[row, :len(wanted)].tolist() == wanted
            row += 1
    assert row == len(inputs)


def test_probabilities_sum_to_one(marks, model):
    tables = model.tables()
    inputs, _ = attention_lm.windows(np.arange(40, dtype=np.int32), np.array([40]), marks.start, marks.none)
    total = 0.0
    for begin in range(0, marks.size, 997):
        wanted = np.arange(begin, min(begin + 997, marks.size), dtype=np.int32)
        targets = np.full((len(wanted), attention_lm.SCORED), -1, np.int32)
        targets[:, 5] = wanted
        scores = attention_lm.log10_scores(model, tables, np.repeat(inputs[1:2], len(wanted), axis=0), targets)
        total += (10 ** scores[:, 5]).sum()
    assert total == pytest.approx(1, abs=1e-3)


def test_no_id_sees_itself_or_what_follows(marks, model):
    tables = model.tables()
    rng = np.random.default_rng(2)
    a = rng.integers(0, 50_000, 50).astype(np.int32)
    b = a.copy()
    b[30:] = rng.integers(0, 50_000, 20)
    scores = []
    for ids in (a, b):
        inputs, targets = attention_lm.windows(ids, np.array([50]), marks.start, marks.none)
        scores.append(attention_lm.log10_scores(model, tables, inputs, targets).ravel()[:50])
    assert np.allclose(scores[0][:30], scores[1][:30], atol=1e-5) and not np.allclose(scores[0][31:], scores[1][31:])


def test_batches_do_not_change_scores(marks, model, monkeypatch):
    texts = [np.array([i for w in attention_lm.words(prose(n)) for i in marks.of_word(w)], np.int32) for n in range(5)]
    lengths, tables = np.array([len(t) for t in texts]), model.tables()
    whole = attention_lm.text_scores(model, tables, np.concatenate(texts), lengths, marks)
    monkeypatch.setattr(attention_lm, "CHUNK", 3)
    alone = [attention_lm.text_scores(model, tables, t, np.array([len(t)]), marks)[0] for t in texts]
    assert np.allclose(whole, alone, rtol=1e-4)


def test_training_helps(marks, model):
    texts = [[i for w in attention_lm.words(prose(n)) for i in marks.of_word(w)] for n in range(100, 120)]
    lengths = np.array([len(t) for t in texts])
    ids = np.concatenate([np.array(t, np.int32) for t in texts])
    raw = attention_lm.train([], np.exp(model.share), marks)
    fresh = attention_lm.Model(model.classes, model.share, raw.weights)
    score = lambda m: attention_lm.text_scores(m, m.tables(), ids, lengths, marks).sum()
    assert score(model) > score(fresh)


def test_gradients_match_differences(marks):
    rng = np.random.default_rng(3)
    classes = rng.integers(0, attention_lm.CLASSES, marks.size)
    width, many = attention_lm.WIDTH, attention_lm.CLASSES
    w = {"e": rng.standard_normal((marks.size + 2, width)), **{n: rng.standard_normal((width, width)) for n in "qkv"},
         "a": rng.standard_normal((width, many)), "x": rng.standard_normal((width, many)),
         "p": rng.standard_normal(attention_lm.LENGTH), "b": rng.standard_normal(many)}
    ids = rng.integers(0, 60, 70).astype(np.int32)
    inputs, targets = attention_lm.windows(ids, np.array([70]), marks.start, marks.none)

    def loss():
        model = attention_lm.Model(classes, np.zeros(marks.size), w)
        e, own = w["e"][inputs], w["e"][inputs][:, attention_lm.CONTEXT:]
        bias = w["p"][np.maximum(attention_lm._BEHIND, 0)] + attention_lm._HIDDEN
        heed = attention_lm.softmax(own @ w["q"] * width ** -0.5 @ (e @ w["k"]).transpose(0, 2, 1) + bias
                                    - 1e4 * (inputs == marks.none)[:, None, :])
        p = attention_lm.softmax(heed @ (e @ w["v"]) @ w["a"] + own @ w["x"] + w["b"])
        there = targets >= 0
        return -np.log(p[there, model.classes[targets[there]]]).mean()

    found = attention_lm.gradients(w, classes, inputs, targets, marks.none)
    for name, grad in found.items():
        flat, g = w[name].reshape(-1), np.asarray(grad).reshape(-1)
        for i in rng.choice(np.flatnonzero(g), min(4, np.count_nonzero(g)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert (up - down) / 2e-5 == pytest.approx(g[i], rel=2e-2, abs=1e-4), name


def test_counts_against_brute_force(documents):
    rows = EDGES + [(1000 + i, prose(i, 80)) for i in range(40)]
    found = attention_lm.score(documents(rows), F.col("id") % 2 == 0, RANKS, public_tokenizers.PATTERN,
                               block_bytes=4000).collect()
    words = [((t or "").encode().lower().split() + [b"\n"], i is None or i % 2 == 0) for i, t in rows]
    counts = Counter(w for found, learnt in words if learnt for w in found)
    total, distinct = sum(counts.values()), len(counts)
    wanted = sorted((str(i), learnt, len(w), sum(counts[x] > 0 for x in w), total,
                     round(sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w), 4))
                    for (i, _), (w, learnt) in zip(rows, words))
    assert sorted((str(r.id), r.learnt, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
                  for r in found) == wanted
    assert all(r.score < 0 for r in found)


def test_without_training_rows_or_rows(documents):
    found = attention_lm.score(documents(EDGES[:5]), F.lit(False), RANKS, public_tokenizers.PATTERN).collect()
    assert len(found) == 5 and {r.train_tokens for r in found} == {0} and {r.n_known for r in found} == {0}
    assert all(r.base_score == 0 and r.score < 0 for r in found)
    assert attention_lm.score(documents([]), F.lit(True), RANKS, public_tokenizers.PATTERN).collect() == []


def test_large_and_small_weights_against_the_definition(marks, model):
    rng = np.random.default_rng(9)
    inputs, targets = attention_lm.windows(rng.integers(0, marks.size, 90).astype(np.int32), np.array([70, 20]),
                                           marks.start, marks.none)
    for scale in (1, 200):
        w = {**model.weights, "q": model.weights["q"] * scale}
        large = attention_lm.Model(model.classes, model.share, w)
        tables = large.tables()
        assert (tables["most"] > attention_lm.SAFE) == (scale > 1)
        e = w["e"].astype(float)[inputs]
        own = e[:, attention_lm.CONTEXT:]
        bias = w["p"][np.maximum(attention_lm._BEHIND, 0)] + attention_lm._HIDDEN
        heed = attention_lm.softmax(own @ w["q"] * attention_lm.WIDTH ** -0.5 @ (e @ w["k"]).transpose(0, 2, 1) + bias
                                    - 1e4 * (inputs == marks.none)[:, None, :])
        p = np.log(attention_lm.softmax(heed @ (e @ w["v"]) @ w["a"] + own @ w["x"] + w["b"]))
        there = targets >= 0
        wanted = np.zeros(targets.shape)
        wanted[there] = (p[there, model.classes[targets[there]]] + model.share[targets[there]]) / np.log(10)
        found = attention_lm.log10_scores(large, tables, inputs, targets)
        assert np.allclose(found, wanted, atol=2e-3)


def test_all_training_rows_are_counted_and_learnt(spark, documents, marks, monkeypatch):
    monkeypatch.setattr(attention_lm, "WINDOWS", 4)
    monkeypatch.setattr(attention_lm, "LEARNT_AT_ONCE", 7)
    rows = EDGES + [(1000 + i, prose(i, 80)) for i in range(4200)]
    seen = {}

    def spied(name):
        plain = getattr(attention_lm, name)

        def run(*args):
            seen[name] = plain(*args)
            return seen[name]
        monkeypatch.setattr(attention_lm, name, run)

    spied("neighbour_counts")
    spied("learnt_from_all")
    found = attention_lm.score(documents(rows), F.col("id") % 2 == 0, RANKS, public_tokenizers.PATTERN, block_bytes=200_000)
    texts = [[i for w in attention_lm.words(t) for i in marks.of_word(w)] for n, t in rows if n is None or n % 2 == 0]
    flat, lengths = np.concatenate(texts), np.array([len(t) for t in texts])
    wanted = attention_lm.neighbours(np.bincount(flat, minlength=marks.size), flat, lengths)
    assert (seen["neighbour_counts"] == wanted).all()
    assert seen["learnt_from_all"][1] == (-(-lengths // attention_lm.SCORED)).sum()
    assert found.count() == len(rows)


def test_texts_are_places_in_their_blocks_lists(documents):
    rows = EDGES + [(1000 + i, " \x0b" * (i % 3) + prose(i, 30) + "\n\x1c \x85É" * (i % 2)) for i in range(40)]
    found = attention_lm.coded(documents(rows), F.col("id") % 2 == 0, "text", "doc_id", 3000).collect()
    lists = {(r.block, r.place): bytes(r.word) for r in found if r.word is not None}
    here = Counter({(r.block, bytes(r.word)): r.here for r in found if r.word is not None})
    texts = [(r.id, r.learnt, r.block, [lists[r.block, i] for i in np.frombuffer(r.codes, np.int32)])
             for r in found if r.codes is not None]
    assert len({block for block, _ in lists}) > 3 and len(set(here)) == len(lists)
    assert sorted((str(i), learnt, cut) for i, learnt, _, cut in texts) == sorted(
        (str(i), i is None or i % 2 == 0, attention_lm.words(t)) for i, t in rows)
    assert +here == Counter((block, word) for _, learnt, block, cut in texts if learnt for word in cut)


def test_every_core_learns_from_as_many_rows(spark, documents, marks, monkeypatch):
    monkeypatch.setattr(attention_lm, "STEPS", 1)
    plain, parts, cores = attention_lm.learnt_from_all, [], spark.sparkContext.defaultParallelism

    def spied(model, learnt, *args):
        rows = learnt.coalesce(1).rdd.union(spark.sparkContext.parallelize([], 2 * cores))
        skewed = spark.createDataFrame(rows, learnt.schema)
        frame, kept = type(learnt), type(learnt).mapInArrow

        def seen(self, *more):
            parts.append([r["count"] for r in self.groupBy(F.spark_partition_id()).count().collect()])
            return kept(self, *more)
        with monkeypatch.context() as patch:
            patch.setattr(frame, "mapInArrow", seen)
            return plain(model, skewed, *args)

    monkeypatch.setattr(attention_lm, "learnt_from_all", spied)
    rows = [(i, prose(i, 20)) for i in range(600)]
    assert attention_lm.score(documents(rows), F.lit(True), RANKS, public_tokenizers.PATTERN).count() == 600
    assert len(parts) == attention_lm.ROUNDS and sum(map(sum, parts)) == 600
    assert [p for p in parts if len(p) != cores or max(p) - min(p) > 4 * cores] == []
