import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from playtide.llm import importance, queries

from .conftest import EDGES, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOW = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def features_of(text, longest):
    words = WORD.findall((text or "").translate(ASCII_LOW))
    return len(words), [" ".join(words[i:i + n]).encode() for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def expected(rows, target, percent, seed, longest=1, buckets=10_000, least=20):
    places = lambda texts: Counter(zlib.crc32(f) % buckets for t in texts for f in features_of(t, longest)[1])
    s, t = places([x for _, x in rows]), places(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    found = []
    for i, text in rows:
        n, features = features_of(text, longest)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
                     for b in (zlib.crc32(f) % buckets for f in features))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        found.append([i, len(features), n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((f for f in found if f[2] >= least), key=lambda f: (-f[4], f[0] is None, f[0] or 0))
    for place, row in enumerate(able[:percent * len(able) // 100]):
        row[5] = place + 1
    return sorted(map(str, found))


def as_rows(frame):
    return sorted(str([r.id, r.n_features, r.n_words, r.weight, r.score, r.rank]) for r in frame.collect())


@pytest.mark.parametrize("longest", [1, 3])
def test_against_brute_force(spark, documents, monkeypatch, longest):
    monkeypatch.setattr(importance, "PIECE", 2000)
    rows = EDGES + [(100 + i, prose(i, 40 + i)) for i in range(60)] + [(300 + i, prose(3, 60)) for i in range(20)]
    target = [prose(i, 50) for i in range(5)] + [None, ""]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.ranked(documents(rows), frame, 30, 7, longest, buckets=500)
    assert as_rows(found) == expected(rows, target, 30, 7, longest, 500)


def test_drawn_rows_keep_their_columns_and_lean_to_the_target(spark, documents):
    rows = [(i, " ".join(["alpha beta gamma delta"] * 6) if i % 4 == 0 else prose(i, 40)) for i in range(400)]
    target = spark.createDataFrame([("alpha beta gamma delta",)] * 20, "text string")
    drawn = importance.resample(documents(rows), target, 10, 1, buckets=50)
    assert drawn.columns == documents([]).columns and drawn.count() == 40
    assert all(r.doc_id % 4 == 0 for r in drawn.collect())


def test_empty(spark, documents):
    nothing = spark.createDataFrame([], "text string")
    assert importance.ranked(documents([]), nothing, 10, 1).collect() == []
    found = importance.ranked(documents(EDGES), nothing, 50, 1)
    assert as_rows(found) == expected(EDGES, [], 50, 1)


def test_equal_keys_do_not_share_a_slot():
    words = [b"one", b"two", b"one", b"three", b"two", b"x" * 300, b"x" * 299 + b"y", b"x" * 300]
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    table = importance.FeatureTable(data, starts, ends, 1000, np.zeros(len(words), np.uint64))
    assert len(set(table.slot)) == len(set(words)) == len(table.used)
    assert [table.count[s] for s in table.slot] == [words.count(w) for w in words]
    assert [table.bucket[s] for s in table.slot] == [zlib.crc32(w) % 1000 for w in words]


def test_many_features_intern_like_a_dictionary():
    rng = random.Random(2)
    words = [str(rng.randrange(3000)).encode() * rng.randint(1, 9) for _ in range(20_000)]
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    table = importance.FeatureTable(data, ends - [len(w) for w in words], ends, 10_000)
    slots = {}
    for word, slot in zip(words, table.slot):
        assert slots.setdefault(word, slot) == slot
    assert len(set(slots.values())) == len(slots)


def test_query_takes_the_dealt_parameters(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = queries.QUERIES["op11_importance"](spark, sf)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str([r.doc_id, r.n_features, r.n_features, r.weight, r.score, r["rank"]]) for r in found.collect()) \
        == expected(rows, target, 10, 2024)
