import random

import numpy as np
import pytest

from playtide.llm import tiling

from .conftest import EDGES, prose


def brute_tiles(text, item, least):
    """Greedy string tiling as it is defined: scan all pairs for the longest free match, mark it, repeat."""
    a, b, tiles = [False] * len(text), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(text)):
            for j in range(len(item)):
                n = 0
                while (i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n]
                       and not a[i + n] and not b[j + n]):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles
        a[i:i + n], b[j:j + n] = [True] * n, [True] * n
        tiles.append((i, j, n))


def test_tiles_against_the_definition():
    rng = random.Random(1)
    for _ in range(60):
        item = [rng.choice("abcd") for _ in range(rng.randint(5, 25))]
        text = [rng.choice("abcd") for _ in range(rng.randint(0, 30))] + item[rng.randint(0, 5):]
        pairs = [(i, j) for i in range(len(text) - 2) for j in range(len(item) - 2) if text[i:i + 3] == item[j:j + 3]]
        found = tiling.greedy_tiles(np.array(pairs), 3, len(text), len(item)) if pairs else []
        wanted = brute_tiles(text, item, 3)
        assert sorted(n for *_, n in found) == sorted(n for *_, n in wanted)
        assert found == wanted


def test_reordered_partial_and_clean(spark, documents):
    items = [(i, prose(1000 + i, 60)) for i in range(30)] + [(90, "too short"), (91, None), (92, "")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    shuffled = items[3][1].split("\n")
    random.Random(2).shuffle(shuffled)
    rows = EDGES + [(200, prose(1) + " " + items[0][1].upper() + " " + prose(2)), (201, "\n".join(shuffled)),
                    (202, " ".join(items[5][1].split()[:12]) + prose(3)), (203, prose(4, 2000)),
                    (204, items[7][1] + items[8][1]), (205, "too short")]
    found = tiling.contaminated(documents(rows), benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(200, 0), (201, 3), (204, 7), (204, 8)]
    assert all(r.covered_words >= 0.8 * r.item_words for r in found)
    kept = tiling.drop_contaminated(documents(rows), benchmark)
    assert kept.columns == documents([]).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in (200, 201, 204))


def test_blocks_do_not_change_the_result(spark, documents):
    items = [(i, prose(1000 + i, 60)) for i in range(20)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents([(i, prose(i) + t) for i, t in items])
    cut = list(tiling.blocks(benchmark, block_bytes=1000))
    assert len(cut) > 5 and sorted(i for block in cut for i in block.ids) == list(range(20))
    assert tiling.contaminated(docs, benchmark).count() == 20


def test_matches_of_repeated_lines_against_the_definition():
    rng = random.Random(5)
    for _ in range(80):
        line = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        item = (line * 6)[:rng.randint(5, 30)] + [rng.choice("abcd") for _ in range(rng.randint(0, 4))]
        text = (line * 20)[rng.randint(0, 4):rng.randint(5, 60)] + [rng.choice("abz") for _ in range(3)]
        block = tiling.Block([(1, " ".join(item)), (2, " ".join(item).upper())], 3)
        wanted = brute_tiles(text, item, 3)
        found = block.matches(" ".join(text), 0.5)
        if sum(n for *_, n in wanted) < 0.5 * len(item):
            assert found == []
        else:
            assert [m["item_id"] for m in found] == [1, 2]
            for match in found:
                assert [(t["text_place"], t["item_place"], t["words"]) for t in match["tiles"]] == wanted


def test_a_repeated_line_is_not_listed_pair_by_pair():
    line = "the quick brown fox jumps over the lazy dog again"
    block = tiling.Block([(0, "\n".join([line] * 20))], 5)
    numbers = block.numbers("\n".join([line] * 2000))
    places = np.arange(len(numbers) - 4)
    # One match for each way of laying the lines over each other.
    assert len(block.items[0].matches(numbers, places, tiling.rolling(numbers, 5))) == 2000 + 20 - 1
    assert block.matches("\n".join(f"{line} {n}" for n in range(5000)), 0.9)[0]["covered_words"] == 200


@pytest.mark.parametrize("kind", ["smallint", "int", "string"])
def test_kinds_of_item_ids(spark, documents, kind):
    item = prose(1000, 60)
    benchmark = spark.createDataFrame([(7, item)], "item_id bigint, text string").selectExpr(
        f"cast(item_id as {kind}) item_id", "text")
    found = tiling.contaminated(documents([(1, item)]), benchmark)
    assert dict(found.dtypes)["item_id"] == kind and found.count() == 1


def test_empty(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert tiling.contaminated(documents(EDGES), none).collect() == []
    assert tiling.drop_contaminated(documents(EDGES), none).count() == len(EDGES)
    assert tiling.contaminated(documents([]), none).collect() == []
