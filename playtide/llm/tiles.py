"""Exact comparison of items tile by tile.

Items lie in bins (tuples of small whole numbers). A bin is cut into tiles of about
``TILE`` items by a hash. Each tile meets the tiles of its own bin and of the bins at the
given offsets once; all others are skipped, so the caller chooses bins for which skipped
pairs cannot be links (population counts, sizes). A pair of tiles is compared with numpy,
and only a spanning forest of its links leaves the task: within a tile pair a link between
items that are already connected adds nothing to a component. So a group of thousands of
near copies yields thousands of rows, not millions, and no component loses a link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm.frames import python_ready, rows_per_batch, stored

TILE = 1024
ROWS = 64  # of a tile that are compared at once

# For rows start:stop of the left tile and the whole right tile, where the links are.
Compare = Callable[[dict, dict, int, int], np.ndarray]


class Forest:
    """Labels of the items of two tiles; linking two labels gives one edge."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def link(self, item: int, others: np.ndarray) -> list[int]:
        """One of ``others`` for each label that was not yet connected with the item."""
        labels, first = np.unique(self.label[others], return_index=True)
        new = labels != self.label[item]
        if not new.any():
            return []
        self.label[np.isin(self.label, labels[new])] = self.label[item]
        return others[first[new]].tolist()


def forest_links(left: dict, right: dict, same: bool, compare: Compare) -> Iterator[tuple[int, int]]:
    """Spanning links between two tiles, or within one, as positions."""
    n = len(left["item"])
    shift = 0 if same else n
    forest = Forest(n if same else n + len(right["item"]))
    for start in range(0, n, ROWS):
        stop = min(n, start + ROWS)
        hits = compare(left, right, start, stop)
        if same:
            hits &= np.arange(n)[None, :] > np.arange(start, stop)[:, None]
        for row in np.flatnonzero(hits.any(axis=1)):
            for other in forest.link(start + row, np.flatnonzero(hits[row]) + shift):
                yield start + row, other - shift


def half(offsets: Iterable[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Of each offset and its opposite, one."""
    return sorted(o for o in set(offsets) if o >= tuple(-x for x in o))


def _unpacked(column: pa.ListArray, row: int) -> dict:
    items = column.values.slice(column.offsets[row].as_py(), len(column[row]))
    found = {}
    for index, field in enumerate(items.type):
        values = items.field(index)
        if pa.types.is_list(field.type):
            bounds = values.offsets.to_numpy()
            found[field.name] = (values.values.to_numpy(), bounds)
        else:
            found[field.name] = values.to_numpy().view(np.uint64) if field.name != "item" else values.to_numpy()
    return found


def links(points: DataFrame, values: list[str], bins: list[str], offsets: Iterable[tuple[int, ...]],
          compare: Compare, salts: int = 1, weight: str = "1", capacity: int = TILE, at_once: int = 256) -> DataFrame:
    """Spanning links ``(a, b)`` of ``points(item, values..., bins...)``, items being distinct.

    ``weight`` says how much of a tile's ``capacity`` an item takes. ``salts`` deals a bin's
    tile pairs over that many keys. A worker gets ``at_once`` tile pairs at a time. The links
    are found when this is called and read from a table.
    """
    sizes = points.groupBy(*bins).agg(F.ceil(F.sum(F.expr(weight)) / F.lit(capacity)).cast("int").alias("blocks"))
    blocked = points.join(sizes, bins).withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    tiles = blocked.groupBy(*bins, "block").agg(F.collect_list(F.struct("item", *values)).alias("tile"))
    moves = F.array(*[F.array(*[F.lit(x) for x in offset]) for offset in half(offsets)])
    left = (tiles.withColumn("move", F.explode(moves))
            .select(*[(F.col(name) + F.col("move")[i]).alias(name) for i, name in enumerate(bins)],
                    F.pmod(F.xxhash64("block", *bins), F.lit(salts)).alias("salt"),
                    F.forall("move", lambda x: x == 0).alias("home"),
                    F.col("block").alias("left_block"), F.col("tile").alias("left")))
    right = tiles.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    pairs = (left.join(right, [*bins, "salt"]).where("not home or left_block <= block")
             .select("left", F.col("tile").alias("right"),
                     F.expr("home and left_block = block").alias("same")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for row, same in enumerate(batch["same"].to_pylist()):
                a, b = _unpacked(batch["left"], row), _unpacked(batch["right"], row)
                found += [(a["item"][i], b["item"][j]) for i, j in forest_links(a, b, same, compare)]
            yield pa.RecordBatch.from_arrays([pa.array([int(x[side]) for x in found], pa.int64()) for side in (0, 1)],
                                             names=["a", "b"])

    spark = python_ready(points.sparkSession)
    with rows_per_batch(spark, at_once):
        return stored(pairs.mapInArrow(run, "a bigint, b bigint"), "tile-links")
