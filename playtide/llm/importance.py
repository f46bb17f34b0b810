"""Draw documents that look like a target, by importance over hashed word runs.

Features are all runs of one to ``longest`` words (A-Z in lower case; a word is a run of
digits, a-z and non-ASCII characters), joined by one blank. A feature's bucket is the CRC-32
of its bytes modulo ``buckets``. Two passes read the texts:

1. features are counted by bucket, over all documents and over all target texts; a task
   sends one row per bucket;
2. a bucket's gain follows from the two counts, a document's weight is the sum of its
   features' gains, and its score adds Gumbel noise fixed by the seed and its identifier,
   so that taking the highest scores draws without replacement in proportion to the weights.

In both passes a batch's features are interned in an open-addressed table of numpy arrays:
XXH64 keys, linear probing for all occurrences at once, and a comparison of the bytes before
two occurrences share a slot. Slots hold bucket and count, so CRC-32 is taken once per
different feature; the slot of each occurrence then gathers its gain.

The ranking is a range-partitioned sort, numbered by one offset per partition.

Defined results: null and empty texts have no features and weight 0. Texts are taken whole,
long ones in pieces that share their last words. Documents with fewer than ``least_words``
words are scored and never drawn. Equal scores go to the smaller identifier, null ones last;
repeated rows are documents of their own, with the same score. A null identifier draws the
noise of an empty one. An empty target or an empty table gives counts of 0.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm.frames import all_columns, map_texts, python_ready, slices, stored, whole_text
from playtide.operators.tables import number_rows

BUCKETS = 10_000
LEAST_WORDS = 20
PIECE = 4 << 20  # bytes of a text whose features are interned at once

# A-Z in lower case, everything that is not part of a word a blank.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
              for c in range(256))
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LONG = 256  # bytes from which two features are compared one by one


def _same_bytes(data: bytes, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the bytes at ``a`` and ``b`` are equal over ``lengths``; ``data`` has eight bytes to spare."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    same = np.ones(len(a), bool)
    live = np.flatnonzero((lengths < _LONG) & (a != b))
    for done in range(0, _LONG, 8):
        live = live[lengths[live] > done]
        if not len(live):
            break
        differ = (words[a[live] + done] ^ words[b[live] + done]) & _LOW_BYTES[np.minimum(lengths[live] - done, 8)]
        same[live[differ != 0]] = False
        live = live[differ == 0]
    for i in np.flatnonzero((lengths >= _LONG) & (a != b)):
        same[i] = data[a[i]:a[i] + lengths[i]] == data[b[i]:b[i] + lengths[i]]
    return same


class FeatureTable:
    """Features of one batch, each in a slot with its bucket and count; ``slot`` has the slot of each occurrence."""

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray, buckets: int, keys: np.ndarray | None = None):
        lengths = ends - starts
        if keys is None:
            digest = xxhash.xxh64_intdigest
            keys = np.fromiter((digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
        mask = (1 << max(4, (2 * len(keys)).bit_length())) - 1
        owner = np.full(mask + 1, -1, np.int64)
        place = (keys & np.uint64(mask)).astype(np.int64)
        self.slot = np.empty(len(keys), np.int64)
        padded = data + bytes(8)
        open_ = np.arange(len(keys))
        while len(open_):
            at = place[open_]
            free = owner[at] < 0
            owner[at[free][::-1]] = open_[free][::-1]  # the first that asks gets the slot
            held = owner[at]
            same = (keys[held] == keys[open_]) & (lengths[held] == lengths[open_])
            same[same] = _same_bytes(padded, starts[held[same]], starts[open_[same]], lengths[open_[same]])
            self.slot[open_[same]] = at[same]
            open_ = open_[~same]
            place[open_] = (place[open_] + 1) & mask
        self.count = np.bincount(self.slot, minlength=mask + 1)
        self.used = np.flatnonzero(owner >= 0)
        self.bucket = np.zeros(mask + 1, np.int64)
        first = owner[self.used]
        self.bucket[self.used] = [zlib.crc32(data[a:b]) % buckets for a, b in
                                  zip(starts[first].tolist(), ends[first].tolist())]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def _pieces(text: str | None, longest: int) -> Iterator[tuple[list[bytes], int]]:
    """Runs of words, and how many of them only lead over from the run before."""
    body = (text or "").encode().translate(_FOLD)
    start, over = 0, []
    while len(body) - start > PIECE:
        cut = body.find(b" ", start + PIECE)
        if cut < 0:
            break
        found = body[start:cut].split()
        yield over + found, len(over)
        over, start = (over + found)[len(over) + len(found) - longest + 1:] if longest > 1 else [], cut
    yield over + body[start:].split(), len(over)


def _tables(texts: list[str | None], longest: int, buckets: int) -> Iterator[tuple[FeatureTable, np.ndarray, np.ndarray]]:
    """Feature tables over some texts: the table, the text of each occurrence, the new words per text."""
    held: list[tuple[int, list[bytes], int]] = []
    size = 0
    for i, text in enumerate(texts):
        for words, over in _pieces(text, longest):
            held.append((i, words, over))
            size += sum(map(len, words))
            if size >= PIECE:
                yield _table(held, len(texts), longest, buckets)
                held, size = [], 0
    if held:
        yield _table(held, len(texts), longest, buckets)


def _table(held, n_texts: int, longest: int, buckets: int):
    words = list(itertools.chain.from_iterable(found for _, found, _ in held))
    data = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[:len(words)]
    sizes = np.array([len(found) for _, found, _ in held], np.int64)
    run = np.repeat(np.arange(len(held)), sizes)
    inside = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # place of a word in its run
    over = np.array([o for _, _, o in held], np.int64)[run]
    text = np.array([i for i, _, _ in held], np.int64)
    parts = []
    for n in range(1, longest + 1):
        last = np.flatnonzero((inside >= n - 1) & (inside >= over))
        parts.append((starts[last - n + 1], ends[last], text[run[last]]))
    begin, end, owner = (np.concatenate(x) for x in zip(*parts))
    fresh = np.bincount(text, weights=sizes - [o for _, _, o in held], minlength=n_texts).astype(np.int64)
    return FeatureTable(data, begin, end, buckets), owner, fresh


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket; what reaches the driver is bounded by ``buckets``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            for table, _, _ in _tables(batch["text"].to_pylist(), longest, buckets):
                np.add.at(total, table.bucket[table.used], table.count[table.used])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    python_ready(texts.sparkSession)
    parts = texts.select(whole_text(text).alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    counts = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def bucket_gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of the smoothed shares of each bucket, rounded down."""
    k, t_all, s_all = len(target), int(target.sum()), int(source.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k))))
                     for t, s in zip(map(float, target), map(float, source))], np.int64)


def noise(seed: int, identifier: object) -> int:
    """Gumbel noise in thousandths, rounded down, fixed by seed and identifier."""
    name = f"{seed}:{'' if identifier is None else identifier}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gains: np.ndarray, seed: int, longest: int = 1, text: str = "text",
           id_column: str = "doc_id", rows: bool = False) -> DataFrame:
    """``id, n_features, n_words, weight, score`` of every document, and its whole ``row`` if wanted."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch["text"].to_pylist()
        weight, features, words = (np.zeros(len(texts), np.int64) for _ in range(3))
        for table, owner, fresh in _tables(texts, longest, len(gains)):
            np.add.at(weight, owner, gains[table.bucket[table.slot]])
            features += np.bincount(owner, minlength=len(texts))
            words += fresh
        score = [int(w) + noise(seed, i.as_py()) for w, i in zip(weight, batch["id"])]
        kept = [batch["row"]] if rows else []
        return pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(features), pa.array(words), pa.array(weight), pa.array(score, pa.int64()), *kept],
            names=["id", "n_features", "n_words", "weight", "score", *["row"] * rows])

    given = docs.select(F.col(f"`{id_column}`").alias("id"), whole_text(text).alias("text"),
                        *[all_columns(docs).alias("row")] * rows)
    kind = given.schema["id"].dataType.simpleString()
    row = f", row {given.schema['row'].dataType.simpleString()}" if rows else ""
    return map_texts(given, run, f"id {kind}, n_features bigint, n_words bigint, weight bigint, score bigint{row}")


def ranked(docs: DataFrame, target: DataFrame, percent: int, seed: int, longest: int = 1, buckets: int = BUCKETS,
           least_words: int = LEAST_WORDS, text: str = "text", target_text: str = "text",
           id_column: str = "doc_id", rows: bool = False) -> DataFrame:
    """Scores of every document with its ``rank`` among the drawn ones, null if it was not drawn.

    Of the documents with ``least_words`` words or more, ``percent`` in a hundred are drawn, rounded down.
    """
    gains = bucket_gains(bucket_counts(target, target_text, longest, buckets),
                         bucket_counts(docs, text, longest, buckets))
    scored = stored(scores(docs, gains, seed, longest, text, id_column, rows), "importance")
    able = scored.where(F.col("n_words") >= least_words)
    places = percent * able.count() // 100
    numbered = number_rows(able, [F.desc("score"), F.asc_nulls_last("id")], "place")
    rank = F.when(F.col("place") < places, F.col("place") + 1)
    return numbered.withColumn("rank", rank).drop("place").unionByName(
        scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint")))


def resample(docs: DataFrame, target: DataFrame, percent: int, seed: int, **settings) -> DataFrame:
    """The drawn documents, with all their columns."""
    return ranked(docs, target, percent, seed, rows=True, **settings).where("rank is not null").select("row.*")
