"""Near copies among embeddings by iterative quantisation.

A rotation is learnt on a sample of ``SAMPLE`` vectors (an upper bound, fewer for wide ones), so
that signs of the rotated vectors keep as much of the vectors as signs can; its bits share the
variance evenly. Vectors are not centred, because links are angles about the origin. Every
vector gets a code of 128 bits. The first bits are cut into substrings, one hash table each;
a vector is put into the bucket of each substring and into those that differ in one of its
``WEAK`` least certain bits. Two vectors that meet in a bucket and differ in few bits of the whole
code are compared in double precision with the original vectors, so nothing below the threshold
is a link. With more vectors the substrings get longer and the tables more, so that
buckets stay small. Only the fit sees a sample; every vector is indexed and every one looks up.

Groups of thousands of near copies would meet in one bucket. Buckets with more than ``HOT``
vectors (or one in 2,000) name a centre, the mean of some members; there are at most 2,000
per table. Vectors within half the threshold's angle of a centre are all linked with each
other, without a comparison. Vectors up to ``REACH`` around it, and others that may still
link with members by the triangle inequality, are compared with the members in tiles, exactly;
counts and spanning links leave a tile, pairs don't. All others go through the tables.

Equal vectors are one entry with a count throughout.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing. Vectors of different length never link. Scaled vectors do, their cosine being 1.
Repeated rows are links of each other like other equal vectors. Null identifiers are
ignored when the smallest is taken unless there is no other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.llm import components
from playtide.llm.frames import drawn_rows, python_ready, rows_per_batch, stored
from playtide.llm.tiles import Forest

SAMPLE = 8_192  # vectors at most that the rotation is learnt from
SAMPLE_NUMBERS = 1 << 21  # components at most of those together
CODE = 128  # bits
WEAK = 5  # least certain bits of a substring that a look-up also tries the other way
HOT = 64  # vectors of a bucket from which it names a centre
NAMING = 32  # members that a centre is the mean of
REACH = math.radians(30)  # around a centre
TILE = 2048
_SAFE = 1e-7  # radians that an angle must be clear of a bound by


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; rows without a direction become NaN."""
    with np.errstate(all="ignore"):
        rows = rows.astype(np.float64)
        rows = rows / np.abs(rows).max(axis=1, initial=0, keepdims=True)
        return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _ragged(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Components end to end and the bounds of each row."""
    bounds = column.offsets.to_numpy()
    values = column.values.slice(bounds[0], bounds[-1] - bounds[0]).to_numpy(zero_copy_only=False)
    return values.astype(np.float64), bounds - bounds[0]


def units(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of a column, filled up with zeros to the longest, and their lengths."""
    values, bounds = _ragged(column)
    sizes = np.diff(bounds)
    found = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        if size:
            found[rows, :size] = unit(values[bounds[rows][:, None] + np.arange(size)])
    return found, sizes


class Quantiser:
    """Projections whose signs are a code, and how codes are cut into tables."""

    def __init__(self, sample: np.ndarray, count: int, seed: int = 11):
        self.width = sample.shape[1]
        self.bits = min(21, max(16, math.ceil(math.log2(max(count, 2)))))
        self.tables = 4 if self.bits == 16 else 5 if self.bits <= 20 else 6
        rng = np.random.default_rng(seed)
        _, axes = np.linalg.eigh(sample.T @ sample)
        axes = axes[:, ::-1][:, :CODE]
        seen, size = sample @ axes, axes.shape[1]
        parts = []
        for turn in range(math.ceil(CODE / size)):
            rotation = np.linalg.qr(rng.standard_normal((size, size)))[0]
            # Few axes have one best rotation, so only the first one is learnt there.
            for _ in range(50 if size >= 16 or not turn else 0):
                left, _, right = np.linalg.svd(np.where(seen @ rotation >= 0, 1.0, -1.0).T @ seen)
                rotation = (left @ right).T
            parts.append(axes @ rotation)
        self.projection = np.concatenate(parts, axis=1)[:, :CODE]

    def rotated(self, vectors: np.ndarray) -> np.ndarray:
        """Values whose signs are the code; vectors of another length are folded to the model's."""
        spare = -vectors.shape[1] % self.width
        if spare or vectors.shape[1] != self.width:
            vectors = np.pad(vectors, ((0, 0), (0, spare))).reshape(len(vectors), -1, self.width).sum(axis=1)
        return vectors @ self.projection

    def codes(self, values: np.ndarray) -> np.ndarray:
        """Two signed 64-bit numbers per vector."""
        return np.packbits(values >= 0, axis=1, bitorder="little").view("<i8")

    def buckets(self, values: np.ndarray, weak: int = WEAK) -> np.ndarray:
        """Per vector and table the bucket of its substring, then those with one weak bit turned."""
        cut = values[:, :self.tables * self.bits].reshape(len(values), self.tables, self.bits)
        place = 1 << np.arange(self.bits)
        own = (cut >= 0) @ place
        turned = own[..., None] ^ place[np.argsort(np.abs(cut), axis=2, kind="stable")[..., :weak]]
        tables = (np.arange(self.tables) << self.bits)[None, :, None]
        return np.concatenate([own[..., None], turned], axis=2) | tables


def _keyed(vectors: DataFrame, vector: str, id_column: str) -> DataFrame:
    """``id, key, vec``: the key is 16 bytes of BLAKE2 over the components, null if the vector has no direction."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["vec"]
            values, sizes = units(column)
            good = (sizes > 0) & np.isfinite(values).all(axis=1) & ~np.array(column.is_null())
            raw, bounds = _ragged(column)
            raw = (raw + 0.0).astype("<f8").tobytes()
            keys = [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() if ok else None
                    for a, b, ok in zip(bounds, bounds[1:], good)]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(keys, pa.binary()), column], names=["id", "key", "vec"])

    kind = vectors.schema[vector].dataType
    narrow = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    element = "float" if narrow else "double"
    given = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").cast(f"array<{element}>").alias("vec"))
    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, key binary, vec array<{element}>")


def _fit(items: DataFrame, count: int, sample: int) -> Quantiser | None:
    width = items.agg(F.mode(F.size("vec"))).first()[0]
    if width is None:
        return None
    rows = max(2, min(sample, SAMPLE_NUMBERS // width))
    drawn = drawn_rows(items.where(F.size("vec") == width).select("key", "vec"), count, rows, "key")
    return Quantiser(unit(np.array([r.vec for r in drawn.select("vec").collect()], np.float64)), count)


def _centres(items: DataFrame, quantiser: Quantiser, hot: int, half: float) -> np.ndarray:
    """Directions of crowded places, none closer to another than ``half``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = quantiser.rotated(units(batch["vec"])[0])
            own = quantiser.buckets(values, 0)[..., 0]
            yield pa.RecordBatch.from_arrays(
                [batch["item"], batch["vec"], pa.array(list(own), pa.list_(pa.int64()))], names=["item", "vec", "buckets"])

    kind = items.schema["vec"].dataType.simpleString()
    placed = items.where(F.size("vec") == quantiser.width).select("item", "vec").mapInArrow(
        run, f"item bigint, vec {kind}, buckets array<bigint>").select("item", "vec", F.explode("buckets").alias("bucket"))
    crowded = stored(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot), "crowded")
    if crowded.isEmpty():
        return np.empty((0, quantiser.width))
    # At most 2,000 buckets per table (see near_vectors): a bounded list.
    some = (placed.join(F.broadcast(crowded), "bucket")
            .withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy(F.xxhash64("item"), "item")))
            .where(F.col("place") <= NAMING))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    parts = some.select("bucket", "n", F.posexplode("vec").alias("at", "x"), norm.alias("norm"))
    means = (parts.groupBy("bucket", "n", "at").agg(F.sum(F.try_divide("x", "norm")).alias("x"))
             .groupBy("bucket", "n").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("mean")))
    found: list[np.ndarray] = []
    for row in means.orderBy(F.desc("n"), "bucket").select("mean.x").toLocalIterator():
        centre = unit(np.array([[0.0 if x is None else x for x in row.x]]))[0]
        if np.isfinite(centre).all() and (not found or (np.array(found) @ centre).max() < math.cos(half)):
            found.append(centre)
    return np.array(found).reshape(-1, quantiser.width)


def _placed(items: DataFrame, quantiser: Quantiser, centres: np.ndarray, theta: float) -> DataFrame:
    """Every vector's centre within reach, whether it is in its core, and other centres it may have links at."""
    some = max(1, (1 << 21) // max(len(centres), 1))  # rows compared with the centres at once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, sizes = units(batch["vec"])
            best, nearest, near = np.zeros(len(sizes), np.int64), np.full(len(sizes), np.pi), [[]] * len(sizes)
            fits = np.flatnonzero(sizes == quantiser.width)
            for start in range(0, len(fits), some):
                rows = fits[start:start + some]
                angles = np.arccos(np.clip(vectors[rows, :quantiser.width] @ centres.T, -1, 1))
                best[rows] = angles.argmin(axis=1)
                nearest[rows] = angles.min(axis=1)
                for row, close in zip(rows, angles <= REACH + theta + _SAFE):
                    close[best[row]] &= nearest[row] > REACH
                    near[row] = np.flatnonzero(close)
            home = nearest <= REACH
            yield pa.RecordBatch.from_arrays(
                [batch["item"], batch["n"], batch["vec"], pa.array(best, mask=~home), pa.array(nearest <= theta / 2 - _SAFE),
                 pa.array(near, pa.list_(pa.int64()))],
                names=["item", "n", "vec", "home", "core", "near"])

    return items.select("item", "n", "vec").mapInArrow(
        run, f"item bigint, n bigint, vec {items.schema['vec'].dataType.simpleString()}, home bigint, core boolean, near array<bigint>")


def _tile_links(placed: DataFrame, threshold: float) -> DataFrame:
    """Links of members outside a core, and of vectors near a group, with the group's members.

    Rows ``item, add, other``: links to add to an item, or a spanning link with another one.
    """
    members = placed.where("home is not null").select(F.col("home").alias("group"), "item", "n", "vec", "core", "home")
    asking = placed.where("home is not null and not core").select(F.col("home").alias("group"), "item", "n", "vec", "core", "home") \
        .unionByName(placed.select(F.explode("near").alias("group"), "item", "n", "vec", "core", "home"))

    def tiled(rows: DataFrame, name: str) -> DataFrame:
        sizes = rows.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("blocks"))
        block = F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")
        return rows.join(sizes, "group").withColumn("block", block).groupBy("group", "block").agg(
            F.collect_list(F.struct("item", "n", "core", "home", "vec")).alias(name))

    # Cells of a square of tile pairs: a tile goes to the cells of its row or of its column.
    side = members.groupBy("group").agg(F.ceil(F.sqrt(F.ceil(F.count(F.lit(1)) / TILE))).cast("int").alias("side"))
    cells = F.explode(F.sequence(F.lit(0), F.col("side") - 1))
    left = tiled(asking, "left").join(side, "group").select(
        "group", (F.col("block") % F.col("side")).alias("row"), cells.alias("column"), "left")
    right = tiled(members, "right").join(side, "group").select(
        "group", cells.alias("row"), (F.col("block") % F.col("side")).alias("column"), "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, a, b in zip(batch["group"].to_pylist(), _tiles(batch["left"]), _tiles(batch["right"])):
                yield _compared(group, a, b, threshold)

    spark = python_ready(placed.sparkSession)
    with rows_per_batch(spark, 8):
        return stored(left.join(right, ["group", "row", "column"]).select("group", "left", "right").mapInArrow(
            run, "item bigint, add bigint, other bigint"), "tile-links")


def _tiles(column: pa.ListArray) -> Iterator[dict]:
    for i in range(len(column)):
        rows = column.values.slice(column.offsets[i].as_py(), len(column[i]))
        vectors, sizes = units(rows.field("vec"))
        yield {"item": rows.field("item").to_numpy(), "n": rows.field("n").to_numpy(), "vectors": vectors, "sizes": sizes,
               "core": rows.field("core").to_numpy(zero_copy_only=False).astype(bool),
               "home": rows.field("home").fill_null(-1).to_numpy()}


def _compared(group: int, a: dict, b: dict, threshold: float) -> pa.RecordBatch:
    width = min(a["vectors"].shape[1], b["vectors"].shape[1])
    joined = np.concatenate([b["item"], a["item"]])
    _, node = np.unique(joined, return_inverse=True)
    forest = Forest(int(node.max(initial=-1)) + 1)
    core = node[:len(b["item"])][b["core"]]
    if len(core):
        forest.label[core] = core[0]
    of_b, of_a, edges = np.zeros(len(b["item"]), np.int64), np.zeros(len(a["item"]), np.int64), []
    names = np.empty(len(forest.label), np.int64)
    names[node] = joined
    for start in range(0, len(a["item"]), 256):
        part = slice(start, start + 256)
        hits = a["vectors"][part, :width] @ b["vectors"][:, :width].T >= threshold
        hits &= a["sizes"][part, None] == b["sizes"][None, :]
        hits &= a["item"][part, None] != b["item"][None, :]
        of_a[part] = hits @ b["n"]
        # A vector without a group is asked about once, and so is one outside the core about the core:
        # both sides count. Two members of groups or two outside the core ask about each other.
        once = (a["home"][part, None] < 0) | ((a["home"][part, None] == group) & b["core"][None, :])
        of_b += a["n"][part] @ (hits & once)
        for row in np.flatnonzero(hits.any(axis=1)):
            own = node[len(b["item"]) + start + row]
            edges += [(int(names[own]), int(names[x])) for x in forest.link(own, node[:len(b["item"])][hits[row]])]
    counted = [(i, c, None) for s, t in ((a["item"], of_a), (b["item"], of_b)) for i, c in zip(s.tolist(), t.tolist()) if c]
    rows = counted + [(i, 0, o) for i, o in edges]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                                      names=["item", "add", "other"])


def _table_links(items: DataFrame, loose: DataFrame, quantiser: Quantiser, threshold: float) -> DataFrame:
    """Links ``a, b, n_a, n_b`` between vectors that meet in a bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = quantiser.rotated(units(batch["vec"])[0])
            buckets, codes = quantiser.buckets(values).reshape(len(values), -1), quantiser.codes(values)
            yield pa.RecordBatch.from_arrays(
                [batch["item"], pa.array(list(buckets), pa.list_(pa.int64())), pa.array(codes[:, 0]), pa.array(codes[:, 1])],
                names=["item", "buckets", "low", "high"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, x_sizes), (y, y_sizes) = units(batch["x"]), units(batch["y"])
            width = min(x.shape[1], y.shape[1])
            cosine = np.einsum("ij,ij->i", x[:, :width], y[:, :width])
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(pa.array((cosine >= threshold) & (x_sizes == y_sizes)))

    entries = loose.mapInArrow(run, "item bigint, buckets array<bigint>, low bigint, high bigint").select(
        F.explode("buckets").alias("bucket"), "item", "low", "high")
    share = math.acos(threshold) / math.pi
    radius = math.ceil(CODE * share + 4 * math.sqrt(CODE * share * (1 - share)))
    entries = stored(entries, "buckets")
    left, right = entries.alias("l"), entries.alias("r")
    apart = F.bit_count(F.col("l.low").bitwiseXOR(F.col("r.low"))) + F.bit_count(F.col("l.high").bitwiseXOR(F.col("r.high")))
    met = left.join(right, (F.col("l.bucket") == F.col("r.bucket")) & (F.col("l.item") < F.col("r.item")) & (apart <= radius))
    pairs = stored(met.select(F.col("l.item").alias("a"), F.col("r.item").alias("b")).distinct(), "met")
    side = lambda name, vec: items.select(F.col("item").alias(name), F.col("n").alias(f"n_{name}"), F.col("vec").alias(vec))
    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "n_a", "n_b", "x", "y")
    return stored(both.mapInArrow(compared, "a bigint, b bigint, n_a bigint, n_b bigint"), "links")


def near_vectors(vectors: DataFrame, threshold: float = 0.95, vector: str = "embedding", id_column: str = "vec_id",
                 sample: int = SAMPLE, hot: int = HOT) -> DataFrame:
    """One row per vector: its id, the number of vectors linked with it, the smallest id that links reach."""
    spark = python_ready(vectors.sparkSession)
    keyed = _keyed(vectors, vector, id_column)
    items = stored(keyed.where("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.first("vec").alias("vec"))
        .withColumn("item", F.monotonically_increasing_id()), "vectors")
    count, theta = items.count(), math.acos(threshold)
    quantiser = _fit(items, count, sample) if count else None
    adds, edges = [], []
    if quantiser:
        centres = _centres(items, quantiser, max(hot, count // 2000), theta / 2)
        loose = items.select("item", "vec")
        if len(centres):
            placed = stored(_placed(items, quantiser, centres, theta), "placed")
            loose = placed.where("home is null").select("item", "vec")
            core = placed.where("core").groupBy("home").agg(F.sum("n").alias("all"), F.min("item").alias("first"))
            members = placed.where("core").join(core, "home")
            tiles = _tile_links(placed, threshold)
            adds += [members.select("item", (F.col("all") - F.col("n")).alias("add")),
                     tiles.where("other is null").select("item", "add")]
            edges += [members.select(F.col("item").alias("a"), F.col("first").alias("b")),
                      tiles.where("other is not null").select(F.col("item").alias("a"), F.col("other").alias("b"))]
        links = _table_links(items, loose, quantiser, threshold)
        adds += [links.select(F.col("a").alias("item"), F.col("n_b").alias("add")),
                 links.select(F.col("b").alias("item"), F.col("n_a").alias("add"))]
        edges.append(links.select("a", "b"))
    named = items.select("item", "key", "n", "least")
    none = F.lit(0).cast("bigint")
    if not edges:
        found = named.select("key", none.alias("add"), "least", "n")
    else:
        added = _union(adds).groupBy("item").agg(F.sum("add").alias("add"))
        root = components.roots(_union(edges))
        rooted = named.join(root, F.col("item") == F.col("node"), "left").withColumn("root", F.coalesce("root", "item"))
        least = rooted.groupBy("root").agg(F.min("least").alias("smallest"))
        found = (rooted.join(least, "root").join(added, "item", "left")
                 .select("key", F.coalesce("add", none).alias("add"), F.col("smallest").alias("least"), "n"))
    found = found.withColumnRenamed("key", "found_key")
    rows = keyed.select("id", "key").join(found, F.col("key") == F.col("found_key"), "left")
    return rows.select(F.col("id").alias(id_column), F.coalesce(F.col("add") + F.col("n") - 1, none).alias("n_links"),
                       F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


def _union(frames: list[DataFrame]) -> DataFrame:
    whole, *rest = frames
    for frame in rest:
        whole = whole.unionByName(frame)
    return whole


def keep_smallest(vectors: DataFrame, threshold: float = 0.95, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """The vectors with the smallest id of what they reach, with all their columns; rows without an id stay."""
    found = near_vectors(vectors, threshold, vector, id_column)
    gone = found.where(F.col(f"`{id_column}`") > F.col("component_id")).select(F.col(f"`{id_column}`").alias("__gone")).distinct()
    return vectors.join(gone, F.col(f"`{id_column}`") == F.col("__gone"), "left_anti")
