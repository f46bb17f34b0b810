"""The prefix trie of conversations: which openings are shared, and what sharing them saves.

A node is a sequence of first turns ``(role, text)`` that at least one conversation starts with;
the root is the empty one. A prefix is known by the exclusive-or of two 64-bit hashes of the
SHA-256 of each turn with its place, running along the conversation: 128 bits that need no turn
text after the first pass. A node is named by the smallest conversation that starts with it and
its depth. Counts come from grouping the prefixes, which Spark adds up before the shuffle, so a
turn that a third of all conversations open with is one row per task there.

Totals over subtrees are taken by centroid decomposition (see ``forest``) of the nodes that two
or more conversations share, one tree per first turn. Subtrees of a single conversation are
chains whose totals are known at once; they enter through the node they hang on.

A node's ending conversations are hashed as one text of ids. Sorted ids are joined in pieces
by all tasks; the pieces of a node are then hashed one after the other, without holding them.

Defined results: rows without a conversation id are left out. Turns are ordered by number,
null first; equal numbers by the SHA-256 of role and text. Null roles and texts are empty.
Repeated rows are turns of their own. An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtide.llm import forest
from playtide.llm.frames import python_ready, spread, stored, whole_text

HEAD = 6  # rebuilt conversations take fewer turns than this from another one
BLOCK = 100  # conversations that share one to take them from
_ENDS = "depth bigint, k1 bigint, k2 bigint"


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv, depth, digest, chars``: the turns of each conversation, numbered from 1."""
    role, text = whole_text("role"), whole_text("text")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", F.char_length(text).cast("bigint").alias("chars"),
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"))
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "digest")
    return rows.select("conv", F.row_number().over(order).cast("bigint").alias("depth"), "digest", "chars")


def lengths_of(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv").agg(F.count(F.lit(1)).alias("len"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations whose first turns are taken from the first one of their block."""
    turns = stored(turns, "turns")
    own = lengths_of(turns)
    head = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(HEAD))
    named = own.select("conv", F.col("len").alias("own"), head.alias("head"), (F.col("conv") - F.col("conv") % BLOCK).alias("base"))
    taken = F.least("head", F.coalesce("base_len", F.lit(0)))
    plan = stored(named.join(own.select(F.col("conv").alias("base"), F.col("len").alias("base_len")), "base", "left")
                  .withColumn("taken", taken)
                  .withColumn("len", F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))), "rebuilt")
    opening = turns.where(F.col("depth") < HEAD).withColumnRenamed("conv", "base")
    heads = plan.select("conv", "base", "head").join(opening, "base").where("depth <= head").select(
        "conv", "depth", "digest", "chars")
    tails = turns.join(plan.select("conv", "head", "taken"), "conv").where("depth > head").select(
        "conv", (F.col("depth") - F.col("head") + F.col("taken")).alias("depth"), "digest", "chars")
    return heads.union(tails), plan.select("conv", "len")


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row per conversation and prefix: its key, its parent's key, its first turn's key."""
    marked = turns.join(lengths, "conv").select(
        "conv", "depth", "len", "chars", F.xxhash64("depth", "digest").alias("x1"),
        F.xxhash64(F.lit("prefix"), "digest", "depth").alias("x2"))
    along = Window.partitionBy("conv").orderBy("depth")
    run = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = marked.select(
        "conv", "depth", "len", "chars", "x1", "x2",
        *[F.bit_xor(f"x{i}").over(run).alias(f"k{i}") for i in (1, 2)],
        *[F.first(f"x{i}").over(run).alias(f"f{i}") for i in (1, 2)])
    return keyed.select("conv", "depth", "len", "chars", "k1", "k2",
                        *[F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}") for i in (1, 2)], "f1", "f2")


def _nodes(members: DataFrame, lengths: DataFrame) -> DataFrame:
    """Prefixes with their members: nodes, the root included, without totals."""
    zero = F.lit(0).cast("bigint")
    counted = [F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")]
    found = members.groupBy("depth", "k1", "k2").agg(
        *counted, F.sum(F.col("len") - F.col("depth") + 1).alias("reach"), F.max("chars").alias("chars"),
        *[F.max(c).alias(c) for c in ("p1", "p2", "f1", "f2")])
    root = lengths.agg(*counted, F.sum(F.col("len") + 1).alias("reach")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "n_convs", "conv", "reach", zero.alias("chars"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("p1", "p2", "f1", "f2")])
    return found.unionByName(root)


def ends_digest(members: DataFrame, lengths: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256`` of nodes at which conversations end."""
    spark = python_ready(members.sparkSession)
    zero = F.lit(0).cast("bigint")
    ends = members.where("depth = len").select("depth", "k1", "k2", "conv").unionByName(
        lengths.where("len = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch[c].to_numpy() for c in ("depth", "k1", "k2")], axis=1)
            starts = np.append(0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)[:len(keys)]
            convs = batch["conv"].to_pylist()
            texts = [",".join(map(str, convs[a:b])) for a, b in zip(starts, [*starts[1:], len(convs)])]
            at = batch.take(pa.array(starts))
            yield pa.RecordBatch.from_arrays([*[at[c] for c in ("depth", "k1", "k2", "conv")], pa.array(texts, pa.string())],
                                             names=["depth", "k1", "k2", "conv", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for d, k1, k2, ids in zip(*[batch[c].to_pylist() for c in ("depth", "k1", "k2", "ids")]):
                if (d, k1, k2) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (d, k1, k2), hashlib.sha256(ids.encode())
            yield _batch(done)
        if key:
            yield _batch([(*key, state.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                                          names=["depth", "k1", "k2", "ends_sha256"])

    parts, key = spread(spark), ["depth", "k1", "k2"]
    joined = (ends.repartitionByRange(parts, *key, "conv").sortWithinPartitions(*key, "conv")
              .mapInArrow(pieces, f"{_ENDS}, conv bigint, ids string"))
    return (joined.repartition(parts, *key).sortWithinPartitions(*key, "conv")
            .mapInArrow(hashed, f"{_ENDS}, ends_sha256 string"))


def trie(turns: DataFrame, lengths: DataFrame, limit: int = forest.LIMIT) -> DataFrame:
    """One row per node, for turns ``conv, depth, digest, chars`` and ``conv, len`` of every conversation.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``; see the module.
    """
    members = stored(prefixes(turns, lengths), "prefixes")
    bare = stored(_nodes(members, lengths), "nodes")
    key = ["depth", "k1", "k2"]
    children = bare.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.coalesce("p1", F.lit(0)).alias("k1"),
                                               F.coalesce("p2", F.lit(0)).alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single"))
    parents = bare.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                          F.col("conv").alias("parent"))
    none = F.lit(0).cast("bigint")
    # All first turns have the root as parent: its name goes to them without a join by key.
    low = bare.where("depth > 1").join(parents, ["depth", "p1", "p2"])
    root = bare.where("depth = 0").select(F.col("conv").alias("parent")).scalar()
    high = bare.where("depth < 2").withColumn("parent", F.when(F.col("depth") == 1, root))
    nodes = stored(low.unionByName(high).join(children, key, "left").withColumns({
        "n_children": F.coalesce("n_children", none), "single": F.coalesce("single", none)}), "trie")

    leaves = F.col("single") + F.when(F.col("n_children") == 0, 1).otherwise(0)
    saved = (F.col("n_convs") - 1) * F.col("chars")
    shared = stored(nodes.where("n_convs > 1 and depth > 0").select(
        F.concat(F.hex("f1"), F.lit("-"), F.hex("f2")).alias("tree"), F.col("conv").alias("chain"), "depth",
        F.when(F.col("depth") > 1, F.col("parent")).alias("up"), "reach", leaves.alias("leaves"), saved.alias("saved")),
        "shared")
    named = nodes.select(*key, F.col("conv").alias("at"))

    def paths(chains: DataFrame) -> DataFrame:
        walked = members.join(chains.select(F.col("chain").alias("conv")), "conv").select("conv", *key)
        return walked.join(named, key).select(F.col("conv").alias("chain"), "depth", "at")

    totals = stored(forest.subtree_totals(shared, paths, ["leaves", "saved"], limit), "totals")
    tops = totals.where("depth = 1").agg(*[F.coalesce(F.sum(c), none).alias(c) for c in ("leaves", "saved")])
    at_root = (nodes.where("depth = 0").select("conv", "depth", leaves.alias("own")).crossJoin(tops)
               .select(F.col("conv").alias("chain"), "depth", (F.col("own") + F.col("leaves")).alias("leaves"), "saved"))
    totals = totals.unionByName(at_root).withColumnRenamed("chain", "conv")
    empty = hashlib.sha256(b"").hexdigest()
    one = F.lit(1).cast("bigint")
    return (nodes.join(totals, ["conv", "depth"], "left").join(ends_digest(members, lengths), key, "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                    F.coalesce("leaves", one).alias("n_leaves"), F.coalesce("saved", none).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of a table ``conv_id, turn, role, text`` as it stands."""
    turns = stored(turns_of(conversations), "turns")
    return trie(turns, stored(lengths_of(turns), "lengths"))
