"""Near duplicates by SimHash, compared exactly in tiles.

A fingerprint bit is 1 if more than half of a text's shingle hashes have it. Fingerprints
within the radius are links; all of them are found, by exclusive-or and bit counts over
tiles (see ``tiles``). Population counts decide which tile pairs are skipped: the distance
of two fingerprints is at least the sum of the differences of their parts' population
counts, here of four parts of 16 bits, so tiles whose counts differ by more than the
radius in sum cannot hold a link.

``near_duplicates`` is for removing documents whose sets of five-word shingles are at least
0.8 alike (Jaccard). Such pairs differ in many bits, so it takes fingerprints of 128 bits
and a wide radius, at which population counts skip little. There tiles are bins of set
sizes, since sets of that likeness differ in size by a quarter at most; candidates are
then compared as sets.

Defined results: null counts as empty. A text without words has the fingerprint zero and
is linked like any other. A text with fewer words than a shingle has one shingle, all its
words. Equal texts always share a component. Null identifiers are ignored when the smallest
one is taken, unless there is no other. Repeated rows give repeated rows in a report; rows
with equal text and identifier are one document and share its fate in ``near_duplicates``.
Empty tables give empty results.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm import components, tiles
from playtide.llm.frames import map_texts, python_ready, stored, whole_text

SEED = 42
PARTS = 4  # of a fingerprint, whose population counts are the bins of a tile
WORDS_REMEMBERED = 100_000
WIDE_RADIUS = 28  # of 128 bits: documents 0.8 alike differ in 19 on average, unrelated ones in 64

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLACE = (np.arange(8) * 256).astype(np.int64)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode().lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, joined by blanks."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(itertools.accumulate(map(len, words)))
    ends = [end + i for i, end in enumerate(ends)]
    starts = [0, *[end + 1 for end in ends]]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:])], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of the hashes, as an unsigned number."""
    if not len(hashes):
        return 0
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    seen = np.bincount((octets + _PLACE).ravel(), minlength=2048).reshape(8, 256)
    return int.from_bytes(np.packbits((seen @ _BITS).ravel() * 2 > len(hashes)).tobytes(), "big")


class WordHashes(dict):
    """XXH64 of words; a bounded memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, SEED)
        return value


_WORD_HASHES = WordHashes()
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                     0xFF51AFD7ED558CCD], np.uint64)


def mixed_shingles(words: list[bytes], size: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of every run of up to five words, from the words' hashes: no bytes are joined."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    count = len(words) - size + 1
    total = np.full(count, salt * 0x2545F4914F6CDD1D % 2**64 + size, np.uint64)
    for i in range(size):
        part = hashes[i:i + count]
        total = (total ^ (part + (part << np.uint64(7 * i + 1)))) * _FACTORS[i]
        total ^= total >> np.uint64(29)
    total *= _FACTORS[0]
    return total ^ (total >> np.uint64(32))


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add each text's 64-bit fingerprint as a signed number."""
    @F.arrow_udf("bigint")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [majority(shingle_hashes(words_of(value.as_py()), words)) for value in batch]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    python_ready(docs.sparkSession)
    return docs.withColumn(out, run(F.col(f"`{text}`")))


def within(radius: int, names: tuple[str, ...]) -> tiles.Compare:
    def compare(left: dict, right: dict, start: int, stop: int) -> np.ndarray:
        apart = sum(np.bitwise_count(left[name][start:stop, None] ^ right[name][None, :]) for name in names)
        return apart <= radius
    return compare


def fingerprint_links(prints: DataFrame, radius: int, column: str = "fingerprint") -> DataFrame:
    """Spanning links ``(a, b)`` between different fingerprints of at most ``radius`` differing bits."""
    width = 64 // PARTS
    names = [f"count{i}" for i in range(PARTS)]
    part = [F.bit_count(F.shiftrightunsigned("item", width * i).bitwiseAND(F.lit((1 << width) - 1)))
            for i in range(PARTS)]
    points = prints.select(F.col(f"`{column}`").alias("item")).distinct().withColumn("bits", F.col("item"))
    near = [o for o in itertools.product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, o)) <= radius]
    return tiles.links(points.withColumns(dict(zip(names, part))), ["bits"], names, near,
                       within(radius, ("bits",)))


def label_near_copies(docs: DataFrame, words: int = 3, radius: int = 2, text: str = "text",
                      id_column: str = "doc_id") -> DataFrame:
    """One row per document: id, fingerprint, and the smallest id that links can reach."""
    prints = stored(fingerprints(docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text")),
                                 words).select("id", "fingerprint"), "fingerprints")
    root = components.roots(fingerprint_links(prints, radius))
    least = prints.groupBy("fingerprint").agg(F.min("id").alias("least"))
    group = F.coalesce("root", "fingerprint")
    rooted = least.join(root, F.col("fingerprint") == F.col("node"), "left")
    smallest = rooted.groupBy(group.alias("group")).agg(F.min("least").alias("smallest"))
    named = rooted.select("fingerprint", group.alias("group")).join(smallest, "group").drop("group")
    return prints.join(named, "fingerprint").select(F.col("id").alias(id_column), "fingerprint",
                                                    F.col("smallest").alias("component_id"))


def alike(threshold: float) -> tiles.Compare:
    """Sets of hashes whose Jaccard likeness reaches the threshold."""
    def compare(left: dict, right: dict, start: int, stop: int) -> np.ndarray:
        (a, a_bounds), (b, b_bounds) = left["shingles"], right["shingles"]
        b_sizes = np.diff(b_bounds)
        b = b[b_bounds[0]:b_bounds[-1]]
        bounds = b_bounds - b_bounds[0]
        hits = np.zeros((stop - start, len(b_sizes)), bool)
        for row in range(start, stop):
            own = a[a_bounds[row]:a_bounds[row + 1]]
            place = np.searchsorted(own, b)
            there = np.append(own, 0)[place] == b
            found = np.concatenate([[0], np.cumsum(there & (place < len(own)))])
            shared = found[bounds[1:]] - found[bounds[:-1]]
            hits[row - start] = shared >= threshold * (len(own) + b_sizes - shared)
        return hits
    return compare


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """Two fingerprints of the different three-word shingles and the number of different longer ones, per text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        low, high, sizes = [], [], []
        for value in batch["text"]:
            found = words_of(value.as_py())
            # Likeness is one of sets, so a shingle that a text repeats counts once here too.
            low.append(majority(np.unique(mixed_shingles(found, 3, 1))))
            high.append(majority(np.unique(mixed_shingles(found, 3, 2))))
            sizes.append(len(np.unique(mixed_shingles(found, words))))
        columns = [batch["item"], batch["id"], *[pa.array(np.array(x, np.uint64).view(np.int64)) for x in (low, high)],
                   pa.array(sizes, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["item", "id", "low", "high", "size"])

    kind = docs.schema["id"].dataType.simpleString()
    return map_texts(docs, run, f"item bigint, id {kind}, low bigint, high bigint, size bigint")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique(mixed_shingles(words_of(value.as_py()), words).view(np.int64)) for value in batch["text"]]
        ends = pa.array(np.cumsum([0, *map(len, found)], dtype=np.int32))
        sets = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found or [np.empty(0, np.int64)])))
        return pa.RecordBatch.from_arrays([batch["item"], batch["root"], sets], names=["item", "root", "shingles"])

    return map_texts(docs, run, "item bigint, root bigint, shingles array<bigint>")


def near_duplicates(docs: DataFrame, words: int = 5, threshold: float = 0.8, text: str = "text",
                    id_column: str = "doc_id") -> DataFrame:
    """The documents that stay: of each group linked by likeness, the one with the smallest id."""
    keyed = docs.withColumn("__item", F.xxhash64(whole_text(text)))
    texts = keyed.select(F.col("__item").alias("item"), F.col(f"`{id_column}`").alias("id"),
                         whole_text(text).alias("text"))
    sketches = stored(_sketches(texts, words), "sketches")
    # Sets alike to the threshold have sizes whose ratio is the threshold or more: neighbouring bins.
    step = F.floor(F.log(F.greatest("size", F.lit(1))) / F.log(F.lit(1 / threshold * 1.0001))).cast("int")
    points = sketches.select("item", "low", "high", step.alias("step")).distinct()
    wide = tiles.links(points, ["low", "high"], ["step"], [(0,), (1,)], within(WIDE_RADIUS, ("low", "high")), salts=8)
    close = components.roots(wide)
    close = stored(close.union(close.select("root", "root").distinct()), "candidates")
    sets = stored(_sets(texts.select("item", "text").join(close, F.col("item") == F.col("node"))
                        .select("item", "text", "root"), words).dropDuplicates(["item"]), "shingles")
    sure = tiles.links(sets, ["shingles"], ["root"], [(0,)], alike(threshold), salts=4,
                       weight="size(shingles) + 64", capacity=1 << 17, at_once=8)
    group = components.roots(sure)
    joined = sketches.join(group, F.col("item") == F.col("node"), "left").select(
        "item", "id", F.coalesce("root", "item").alias("root"))
    first = joined.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "item")).alias("first"))
    gone = (joined.join(first, "root").where("id is distinct from first.id or item <> first.item")
            .select(F.col("item").alias("gone"), F.col("id").alias("gone_id")).distinct())
    stays = keyed.join(gone, (F.col("__item") == F.col("gone"))
                       & F.col(f"`{id_column}`").eqNullSafe(F.col("gone_id")), "left_anti")
    return stays.drop("__item")
