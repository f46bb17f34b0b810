import itertools
import random

import numpy as np
import pytest
import xxhash

from playtide.llm import components, simhash, tiles

from .conftest import EDGES, prose


def plain_print(text, size=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(names, linked):
    root = {n: n for n in names}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(names, 2):
        if linked(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {n: find(n) for n in names}


def test_report_against_brute_force(documents):
    rng = random.Random(3)
    rows = [(i, t) for i, t in EDGES if i != 6]
    for i in range(60):
        text = prose(i % 20, 400)
        words = text.split(" ")
        for _ in range(i // 20):
            words[rng.randrange(len(words))] = "changed"
        rows.append((100 + i, " ".join(words)))
    found = simhash.label_near_copies(documents(rows)).collect()
    assert len(found) == len(rows)
    prints = {t: plain_print(t) for _, t in rows}
    ids = {}
    for i, t in rows:
        ids[prints[t]] = min((x for x in (ids.get(prints[t]), i) if x is not None), default=None)
    group = classes(list(ids), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for p, i in ids.items():
        least[group[p]] = min((x for x in (least.get(group[p]), i) if x is not None), default=None)
    wanted = sorted((str(i), prints[t], str(least[group[prints[t]]])) for i, t in rows)
    assert sorted((str(r.doc_id), r.fingerprint % 2**64, str(r.component_id)) for r in found) == wanted


@pytest.mark.parametrize("size", [8, 1024])
def test_tiles_find_every_component(spark, monkeypatch, size):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 40)
    prints = {int(s) ^ (1 << int(b)) ^ (1 << int(c)) for s in seeds for b, c in rng.integers(0, 62, (12, 2))}
    monkeypatch.setattr(tiles, "TILE", size)
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint bigint")
    links = simhash.fingerprint_links(frame, 2)
    root = {r.node: r.root for r in components.roots(links).collect()}
    wanted = classes(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 2)
    assert {p: root.get(p, p) for p in prints} == wanted


def test_links_are_a_forest(spark):
    frame = spark.createDataFrame([(1 << i,) for i in range(62)], "fingerprint bigint")  # all two bits apart
    # Four tiles of 16, 16, 16 and 14: at most a tree per pair of tiles, of 1,891 links.
    assert simhash.fingerprint_links(frame, 2).count() <= 58 + 3 * 62


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    root = {r.node: r.root for r in components.roots(frame).collect()}
    assert root == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}
    assert components.roots(frame.limit(0)).collect() == []


def likeness(a, b):
    def sets(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    x, y = sets(a), sets(b)
    return len(x & y) >= 0.8 * len(x | y)


def test_near_duplicates_against_brute_force(documents):
    rng = random.Random(9)
    rows = [(i, t) for i, t in EDGES if i is not None]
    for i in range(90):
        words = prose(i % 15, 300).split(" ")
        for _ in range(i // 15 * 2):
            words[rng.randrange(len(words))] = f"other{rng.randrange(99)}"
        rows.append((100 + i, " ".join(words)))
    docs = documents(rows)
    kept = simhash.near_duplicates(docs)
    assert kept.columns == docs.columns
    texts = dict((t or "", i) for i, t in sorted(rows, reverse=True))  # the smallest id of each text
    group = classes(sorted(texts.values()), lambda a, b: likeness(dict(rows)[a], dict(rows)[b]))
    found = {r.doc_id for r in kept.select("doc_id").collect()}
    wanted = set(group.values())
    assert found - wanted == set() and len(wanted - found) == 0


def test_near_copies_with_a_line_repeated_more_often(documents):
    own, line = " ".join(f"word{i}" for i in range(300)), " ".join(f"line{i}" for i in range(10))
    texts = [" ".join([own, *[line] * times]) for times in (1, 10, 20, 50, 100)]
    assert all(likeness(texts[0], text) for text in texts)
    assert [r.doc_id for r in simhash.near_duplicates(documents(list(enumerate(texts)))).collect()] == [0]


def test_empty(documents):
    assert simhash.label_near_copies(documents([])).collect() == []
    assert simhash.near_duplicates(documents([])).collect() == []
