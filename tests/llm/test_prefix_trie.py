import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from playtide.llm import forest, prefix_trie, queries


def totals_by_hand(parent, values):
    found = values.copy()
    for node in range(len(parent)):
        above = parent[node]
        while above >= 0:
            found[above] += values[node]
            above = parent[above]
    return found


def random_forest(rng, n, shape):
    if shape == "path":
        parent = [i - 1 for i in range(n)]
    elif shape == "star":
        parent = [-1] + [0] * (n - 1)
    else:
        parent = [rng.randrange(max(0, i - shape), i) if i and rng.random() > 0.02 else -1 for i in range(n)]
    depth = []
    for p in parent:
        depth.append(1 if p < 0 else depth[p] + 1)
    return np.array(parent), np.array(depth)


@pytest.mark.parametrize("shape", ["path", "star", 1, 3, 10_000])
def test_totals_of_any_shape(shape):
    rng = random.Random(str(shape))
    for n in (1, 2, 7, 300):
        parent, depth = random_forest(rng, n, shape)
        values = np.array([[rng.randrange(100), 1] for _ in range(n)])
        weight = np.array([[rng.randint(1, 50)] for _ in range(n)])
        reach = totals_by_hand(parent, weight)[:, 0]
        assert (forest.centroid_totals(parent, depth, reach, values) == totals_by_hand(parent, values)).all()


def chains_of(parent, depth):
    """A chain for every node: that of its first child in order, so that chains run along paths."""
    chain = list(range(len(parent)))
    for node in reversed(range(len(parent))):
        children = [c for c in range(node + 1, len(parent)) if parent[c] == node]
        if children:
            chain[node] = chain[children[0]]
    return chain


@pytest.mark.parametrize("shape", ["path", "star", 4, 10_000])
@pytest.mark.parametrize("limit", [1, 9])
def test_spark_splits_large_trees(spark, shape, limit):
    rng = random.Random(str(shape))
    parent, depth = random_forest(rng, 60, shape)
    chain = chains_of(parent, depth)
    values = np.array([[rng.randrange(100), 1] for _ in parent])
    reach = totals_by_hand(parent, np.ones((len(parent), 1), int))[:, 0]
    tree = list(range(len(parent)))
    for i, p in enumerate(parent):
        tree[i] = i if p < 0 else tree[p]
    rows = [(str(tree[i]), chain[i], int(depth[i]), None if p < 0 else chain[p], int(reach[i]), int(values[i][0]), 1)
            for i, p in enumerate(parent)]
    nodes = spark.createDataFrame(rows, "tree string, chain bigint, depth bigint, up bigint, reach bigint, a bigint, b bigint")
    walks = []
    for i in {max((d, i) for i, (c, d) in enumerate(zip(chain, depth)) if c == x)[1] for x in set(chain)}:
        own, at = chain[i], i
        while at >= 0:
            walks.append((own, int(depth[at]), chain[at]))
            at = parent[at]
    walks = spark.createDataFrame(walks, "chain bigint, depth bigint, at bigint")
    found = forest.subtree_totals(nodes, lambda chains: walks.join(chains, "chain"), ["a", "b"], limit).collect()
    wanted = totals_by_hand(parent, values)
    assert sorted(map(tuple, found)) == sorted((chain[i], int(depth[i]), *map(int, wanted[i])) for i in range(len(parent)))


def by_hand(paths):
    """Nodes of the trie over ``{conv: [(role, text), ...]}``."""
    members = defaultdict(list)
    for conv, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    rows = []
    for prefix, convs in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(prefix))
        rows.append((min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs), len(children[prefix]),
                     sum(not children[p] for p in below), sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, k1 string, len string"


def random_turns(seed, convs):
    rng = random.Random(seed)
    rows = []
    for conv in convs:
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "bot"]) if turn % 2 else "user", rng.choice(["a", "bb", "ça"])))
    return rows


EDGES = [(None, 1, "user", "lost"), (500, None, "user", "zero"), (500, 1, None, None), (500, 2, "user", "x" * 100_000),
         (501, 3, "user", "same"), (501, 3, "user", "same"), (501, 3, "bot", "tie"), (-7, 0, "user", "a"), (502, 0, "us", "era"),
         (503, 0, "user", "a"), (504, 0, "", "\x00"), *[(600 + i, 0, "user", "hot") for i in range(30)],
         *[(600 + i, 1, "bot", "hot") for i in range(15)]]


def ordered(rows):
    paths = defaultdict(list)
    digest = lambda r, t: hashlib.sha256(f"{len(r or '')}:{r or ''}{t or ''}".encode()).digest()
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None),
                                         key=lambda r: (r[0], r[1] is not None, r[1] or 0, digest(*r[2:]))):
        paths[conv].append((role or "", text or ""))
    return paths


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "l") for r in rows], SCHEMA)


@pytest.mark.parametrize("limit", [2, forest.LIMIT])
def test_trie_against_brute_force(spark, limit):
    rows = random_turns(3, range(60)) + EDGES
    turns = prefix_trie.turns_of(table(spark, rows))
    found = prefix_trie.trie(turns, prefix_trie.lengths_of(turns), limit).collect()
    assert sorted(map(tuple, found), key=str) == by_hand(ordered(rows))


def test_rebuilt_conversations_against_brute_force(spark):
    rows = random_turns(4, [*range(-120, -90), *range(0, 40), *range(250, 270)]) + EDGES
    own = ordered(rows)
    paths = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - int(np.fmod(conv, 100))
        paths[conv] = own.get(base, [])[:h] + turns[h:]
    assert any(not turns for turns in paths.values())
    found = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turns_of(table(spark, rows)))).collect()
    assert sorted(map(tuple, found), key=str) == by_hand(paths)


def test_empty(spark):
    assert prefix_trie.conversation_trie(table(spark, [])).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    own = ordered(rows)
    paths = {c: own.get(c - c % 100, [])[:zlib.crc32(str(c).encode()) % 6] + t[zlib.crc32(str(c).encode()) % 6:]
             for c, t in own.items()}
    found = queries.QUERIES["op13_prefix_trie"](spark, sf)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                             "ends_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == by_hand(paths)
