import random
from collections import Counter

import pytest

from playtide.operators import paging


def by_hand(pages):
    """Position by position."""
    found, albums = set(), {p[0] for p in pages if p[0] is not None}
    for album in albums:
        own = [(o or 0, len(i or ()), t) for a, o, i, t in pages if a == album]
        totals = [t for *_, t in own if t is not None]
        length = max(totals) if totals else max(o + n for o, n, _ in own)
        different = {(o, n) for o, n, _ in own}
        covers = [sum(o <= x < o + n for o, n in different) for x in range(max(length, max(o + n for o, n, _ in own)))]
        start = 0
        for x in range(1, len(covers) + 1):
            if x == len(covers) or covers[x] != covers[start] or (covers[start] == 0 and x == length):
                if covers[start] > 1 or (covers[start] == 0 and start < length):
                    found.add((album, "overlap" if covers[start] else "gap", start, x, covers[start]))
                start = x
        for (o, n), copies in Counter((o, n) for o, n, _ in own).items():
            if copies > 1:
                found.add((album, "repeat", o, o + n, copies))
    return found


@pytest.mark.parametrize("seed", range(3))
def test_against_positions(spark, seed):
    rng = random.Random(seed)
    pages = [(f"a{rng.randrange(8)}", rng.choice([None, *range(0, 60, 5)]), [1] * rng.choice([0, 3, 5, 5, 5, 12]),
              rng.choice([None, 40, 40, 55])) for _ in range(60)]
    pages += [("whole", 0, [1] * 50, 100), ("whole", 50, [1] * 50, 100), ("none", 0, [], 0), ("null", 3, None, None), (None, 0, [1], 1),
              ("hot", 0, [1], 4)] + [("hot", 2, [1, 1], 4)] * 300
    df = spark.createDataFrame(pages, "album_id string, offset bigint, items array<int>, total bigint").repartition(4)
    assert {tuple(r) for r in paging.page_gaps(df).collect()} == by_hand(pages)


def test_no_pages(spark):
    df = spark.createDataFrame([], "album_id string, offset bigint, items array<int>, total bigint")
    assert paging.page_gaps(df).collect() == []
