"""Subtree totals of a forest by centroid decomposition.

A forest is a table of nodes with parent edges. Nodes are named ``(chain, depth)``; ``up`` is the
chain of the parent, which has the depth before, null at a top. Every node carries ``reach``, a
positive weight summed over its subtree, which serves to find centroids.

The centroid of a component is its deepest node with more than half of the reach of the
component's top. Its subtree within the component is totalled, the totals are added to every
node on the path from the centroid to the top, and the centroid is taken out: what hung on it
and what is above it are components of their own, none with more than half of the reach. So
a node takes part in as many rounds as the logarithm of its tree's reach, however deep or
wide the tree is; when it is taken out itself, it has its subtree's totals.

Trees of up to ``LIMIT`` nodes are dealt to tasks, which decompose all of theirs at once with
numpy. Larger ones are first decomposed by Spark, one round over all of their components at a
time, until no component has more than ``LIMIT`` nodes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtide.llm.frames import python_ready, spread, stored

LIMIT = 50_000  # nodes of a component that one task decomposes


def centroid_totals(parent: np.ndarray, depth: np.ndarray, reach: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Totals of ``values`` (one row per node) over each node's subtree; ``parent`` is -1 at tops."""
    n = len(parent)
    totals, reach = np.zeros_like(values), reach.copy()
    gone, top, place = np.zeros(n + 1, bool), np.empty(n, np.int64), np.empty(n, np.int64)
    gone[-1] = True  # where tops point to
    live = np.argsort(depth, kind="stable")
    while len(live):
        depths = depth[live]
        levels = np.split(live, np.flatnonzero(np.diff(depths)) + 1)
        for level in levels:
            above = parent[level]
            top[level] = np.where(gone[above], level, top[above])
        heavy = live[2 * reach[live] > reach[top[live]]]  # chains downwards from each top, in order of depth
        place[top[heavy]] = heavy  # the deepest comes last and stays
        centroids = place[heavy[top[heavy] == heavy]]
        under = np.zeros(n + 1, bool)
        under[centroids] = True
        for level in levels:
            above = parent[level]
            under[level] |= under[above] & ~gone[above]
        inside = live[under[live]]
        sums = np.zeros_like(values)
        np.add.at(sums, top[inside], values[inside])
        at, amount, share = centroids, sums[top[centroids]], reach[centroids]
        while len(at):
            totals[at] += amount
            reach[at] -= share
            up = at != top[at]
            at, amount, share = parent[at[up]], amount[up], share[up]
        gone[centroids] = True
        live = live[~gone[live]]
    return totals


def _small_trees(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Totals of trees that a task may hold: a stream of trees, as many at once as a batch has."""
    def decomposed(rows: pa.Table) -> pa.RecordBatch:
        tree = rows["tree"].combine_chunks().dictionary_encode().indices.to_numpy()
        chain, depth = rows["chain"].to_numpy(), rows["depth"].to_numpy()
        up = rows["up"].fill_null(0).to_numpy()
        _, chains = np.unique(np.concatenate([chain, up]), return_inverse=True)
        key = (tree * (int(depth.max()) + 1) + depth) * (int(chains.max()) + 1)
        own, wanted = key + chains[:len(chain)], key - (int(chains.max()) + 1) + chains[len(chain):]
        order = np.argsort(own)
        parent = order[np.minimum(np.searchsorted(own, wanted, sorter=order), len(own) - 1)]
        parent = np.where(rows["up"].is_null().to_numpy(), -1, parent)
        found = centroid_totals(parent, depth, rows["reach"].to_numpy(),
                                np.stack([rows[v].to_numpy() for v in values], axis=1))
        return pa.RecordBatch.from_arrays([pa.array(chain), pa.array(depth), *[pa.array(c) for c in found.T]],
                                          names=["chain", "depth", *values])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            trees = rows["tree"].combine_chunks().dictionary_encode().indices.to_numpy()
            last = int(np.flatnonzero(trees == trees[-1])[0]) if len(trees) else 0
            if last:
                yield decomposed(rows.slice(0, last))
            rest = rows.slice(last)
        if rest is not None and rest.num_rows:
            yield decomposed(rest)

    spark = python_ready(nodes.sparkSession)
    dealt = (nodes.select("tree", "chain", "depth", "up", "reach", *values)
             .repartition(spread(spark), "tree").sortWithinPartitions("tree", "depth"))
    return dealt.mapInArrow(run, "chain bigint, depth bigint, " + ", ".join(f"{v} bigint" for v in values))


def _split(nodes: DataFrame, paths: DataFrame, values: list[str], limit: int) -> tuple[list[DataFrame], DataFrame]:
    """Decompose until no component exceeds ``limit``: finished nodes with their totals, and the remaining nodes."""
    finished: list[DataFrame] = []
    top = ["top_chain", "top_depth"]
    tops = nodes.where("up is null").select("tree", F.col("chain").alias("top_chain"), F.col("depth").alias("top_depth"))
    state = stored(nodes.join(tops, "tree").drop("tree").withColumns({f"{v}_sum": F.lit(0).cast("bigint") for v in values}),
                   "forest")
    # Every path of a chain with a large tree, with the chain of the next deeper node.
    steps = stored(paths.withColumn("below", F.lead("at").over(Window.partitionBy("chain").orderBy("depth"))), "forest-paths")
    while True:
        is_top = (F.col("chain") == F.col("top_chain")) & (F.col("depth") == F.col("top_depth"))
        large = state.groupBy(*top).agg(F.count(F.lit(1)).alias("n"), F.max(F.when(is_top, F.col("reach"))).alias("all")) \
            .where(F.col("n") > limit)
        heavy = state.join(large, top).where("2 * reach > all")
        centroids = stored(heavy.groupBy(*top).agg(F.max_by(F.struct("chain", "depth", "reach"), "depth").alias("z"))
                           .select(*top, F.col("z.chain").alias("z_chain"), F.col("z.depth").alias("z_depth"),
                                   F.col("z.reach").alias("z_reach")), "centroids")
        if centroids.isEmpty():
            return finished, state
        through = (steps.join(centroids, (F.col("at") == F.col("z_chain")) & (F.col("depth") == F.col("z_depth")))
                   .select("chain", *top, "z_chain", "z_depth", "below"))
        marked = stored(state.join(through, ["chain", *top], "left")
                        .withColumn("under", F.coalesce(F.col("depth") >= F.col("z_depth"), F.lit(False))), "forest-marked")
        sums = marked.where("under").groupBy(*top).agg(*[F.sum(v).alias(f"{v}_add") for v in values])
        path = (steps.withColumnRenamed("chain", "z_chain").withColumnRenamed("depth", "step")
                .join(centroids.join(sums, top), "z_chain").where("step between top_depth and z_depth")
                .select(F.col("at").alias("chain"), F.col("step").alias("depth"), "z_reach",
                        *[f"{v}_add" for v in values]))
        moved = marked.join(path, ["chain", "depth"], "left")
        none = F.lit(0).cast("bigint")
        moved = moved.withColumns({f"{v}_sum": F.col(f"{v}_sum") + F.coalesce(f"{v}_add", none) for v in values})
        is_centroid = F.coalesce((F.col("chain") == F.col("z_chain")) & (F.col("depth") == F.col("z_depth")), F.lit(False))
        # Below the centroid a component's top is the next node of the path, without a parent from now on.
        new_top = (F.col("depth") == F.col("z_depth") + 1) & F.col("under")
        after = stored(moved.select(
            "chain", "depth", F.when(~new_top, F.col("up")).alias("up"),
            (F.col("reach") - F.coalesce("z_reach", none)).alias("reach"), *values, *[f"{v}_sum" for v in values],
            F.when(F.col("under"), F.col("below")).otherwise(F.col("top_chain")).alias("top_chain"),
            F.when(F.col("under"), F.col("z_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            is_centroid.alias("out")), "forest")
        finished.append(after.where("out").select("chain", "depth", *[F.col(f"{v}_sum").alias(v) for v in values]))
        state = after.where("not out").drop("out")


def subtree_totals(nodes: DataFrame, paths: Callable[[DataFrame], DataFrame], values: list[str],
                   limit: int = LIMIT) -> DataFrame:
    """``chain, depth`` and the totals of ``values`` over the subtree of every node.

    ``nodes`` has ``tree, chain, depth, up, reach`` and the values, all bigint but ``tree``, and should be
    stored: it is read more than once. ``paths(chains)`` gives ``chain, depth, at``: for every chain of the
    given table the nodes ``(at, depth)`` from its tree's top to its own deepest node; it is asked for
    trees above the limit only.
    """
    large = nodes.groupBy("tree").count().where(F.col("count") > limit).select("tree")
    large = stored(large, "large-trees")
    if large.isEmpty():
        return _small_trees(nodes, values)
    giants = nodes.join(large, "tree", "left_semi")
    finished, state = _split(giants, paths(giants.select("chain").distinct()), values, limit)
    label = F.concat_ws(":", "top_chain", "top_depth")
    inner = _small_trees(state.withColumn("tree", label), values)
    before = state.select("chain", "depth", *[F.col(f"{v}_sum") for v in values])
    rest = inner.join(before, ["chain", "depth"]).select(
        "chain", "depth", *[(F.col(v) + F.col(f"{v}_sum")).alias(v) for v in values])
    small = _small_trees(nodes.join(large, "tree", "left_anti"), values)
    return reduce(DataFrame.unionByName, [small, rest, *finished])
