"""Quality by kernel ridge regression on document statistics.

A text is described by a few statistics (lengths, shares of kinds of characters and words,
repetition). Random Fourier features approximate a Gaussian kernel on them. Every partition
adds up its own normal equations, the sums are added in two steps, and the ridge weights are
solved from them, so all labelled training rows count. Isotonic regression on a grid of
scores turns them into probabilities that never fall as the ridge score rises.

Defined results: null and empty texts have statistics of zero. Without training rows every
score is 0; with one label only, it is that label. Null labels and ids are ignored in
training. Repeated rows get equal scores and count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.llm.frames import python_ready

FEATURES = 192
RIDGE = 1e-3  # per training row
WIDTH = 2.5  # of the kernel, in standard deviations of a statistic
GRID = 1024  # cells of ridge scores from LOW to HIGH for the isotonic fit
LOW, HIGH = -0.5, 1.5
GROUP = 64  # partitions whose sums are added in one task

_SIGNS = [b"|", b"!", b"#$%&*", b".", b",", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
          b"abcdefghijklmnopqrstuvwxyz", b"\n"]
_CLASSES = np.zeros((256, len(_SIGNS) + 1))
for _place, _signs in enumerate(_SIGNS):
    _CLASSES[list(_signs), _place] = 1
_CLASSES[128:, len(_SIGNS)] = 1
STATISTICS = 18


def statistics(text: str | None) -> np.ndarray:
    """The numbers that describe a text; all bounded, so that no text dominates a sum."""
    out = np.zeros(STATISTICS)
    words = (text or "").split()
    if not words:
        return out
    octets = np.frombuffer(text.encode(), np.uint8)
    kinds = np.bincount(octets, minlength=256) @ _CLASSES
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in text.split("\n") if line]
    out[:5] = np.minimum(kinds[:5] / n, 2)
    out[5:10] = kinds[5:] / len(octets)
    out[10] = np.log1p(n)
    out[11] = np.log1p(lengths.mean())
    out[12] = np.log1p(lengths.std())
    out[13] = len(set(words)) / n
    out[14] = (lengths <= 3).mean()
    out[15] = 1 - len(set(lines)) / max(len(lines), 1)
    out[16] = np.log1p(n / max(len(lines), 1))
    out[17] = sum(map(str.isupper, words)) / n
    return out


def with_statistics(docs: DataFrame, text: str = "text", out: str = "statistics") -> DataFrame:
    """Add the statistics of each whole text as ``array<double>``."""
    @F.arrow_udf("array<double>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [statistics(value.as_py()) for value in batch]
            values = np.concatenate(found) if found else np.empty(0)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * STATISTICS),
                                           pa.array(values))

    python_ready(docs.sparkSession)
    return docs.withColumn(out, run(F.col(f"`{text}`")))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray  # ridge scores from which on
    levels: np.ndarray  # these probabilities hold

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return fourier((x - self.mean) / self.scale) @ self.weights

    def probability(self, x: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.edges, self.ridge(x), "right") - 1
        return self.levels[np.maximum(place, 0)]


def fourier(x: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    rng = np.random.default_rng(11)
    waves = rng.standard_normal((STATISTICS, FEATURES)) / WIDTH
    shift = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.cos(np.clip(x, -6, 6) @ waves + shift) * np.sqrt(2 / FEATURES)
    return np.concatenate([z, np.ones((len(x), 1))], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, STATISTICS)


def _summed(rows: DataFrame, make, size: int) -> np.ndarray:
    """Add ``make(statistics, labels)`` over all partitions; the driver gets one sum per GROUP partitions."""
    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                total, seen = total + make(_matrix(batch["statistics"]), batch["label"].to_numpy()).ravel(), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    def group(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(value.as_py()) for value in table["total"])
        return pa.table({"total": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select("statistics", "label").mapInArrow(partition, "total binary")
    keyed = parts.withColumn("part", F.floor(F.spark_partition_id() / GROUP))
    sums = keyed.groupBy("part").applyInArrow(lambda table: group(table), "total binary").collect()
    return sum((np.frombuffer(row.total) for row in sums), np.zeros(size))


def isotonic(score: np.ndarray, weight: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: where each level begins, and the levels."""
    blocks: list[list[float]] = []
    for s, w, h in zip(score, weight, hits):
        blocks.append([s, w, h])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            _, w1, h1 = blocks.pop()
            blocks[-1][1] += w1
            blocks[-1][2] += h1
    return np.array([b[0] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(rows: DataFrame) -> Model | None:
    """The model of ``rows(statistics, label)``; None without rows."""
    python_ready(rows.sparkSession)
    d = STATISTICS
    first = _summed(rows, lambda x, y: np.concatenate([[len(x)], x.sum(axis=0), (x ** 2).sum(axis=0)]), 1 + 2 * d)
    count = first[0]
    if not count:
        return None
    mean = first[1:1 + d] / count
    scale = np.sqrt(np.maximum(first[1 + d:] / count - mean ** 2, 0)) + 1e-3

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = fourier((x - mean) / scale)
        return z.T @ np.concatenate([z, y[:, None]], axis=1)

    n = FEATURES + 1
    sums = _summed(rows, equations, n * (n + 1)).reshape(n, n + 1)
    penalty = np.diag(np.r_[np.full(FEATURES, RIDGE * count), 1e-9 * count])
    weights = np.linalg.solve(sums[:, :n] + penalty, sums[:, n])
    model = Model(mean, scale, weights, np.zeros(1), np.zeros(1))

    def cells(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        place = np.clip((model.ridge(x) - LOW) / (HIGH - LOW) * GRID, 0, GRID - 1).astype(np.int64)
        return np.stack([np.bincount(place, minlength=GRID), np.bincount(place, y, GRID)])

    weight, hits = _summed(rows, cells, 2 * GRID).reshape(2, GRID)
    there = weight > 0
    grid = LOW + (HIGH - LOW) / GRID * np.arange(GRID)
    model.edges, model.levels = isotonic(grid[there], weight[there], hits[there])
    return model


def training_rows(described: DataFrame, labels: DataFrame, label: str, allowed: Column,
                  id_column: str = "doc_id") -> DataFrame:
    """``statistics, label`` of the labelled rows that may be learnt from."""
    marked = (labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").cast("double").alias("label"))
              .where("label is not null and id is not null").where(allowed))
    return described.select(F.col(f"`{id_column}`").alias("id"), "statistics").join(marked, "id").select(
        "statistics", "label")


def score(described: DataFrame, model: Model | None, out: str = "score") -> DataFrame:
    """Add the probability of label 1 to rows with statistics."""
    @F.arrow_udf("double")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(model.probability(_matrix(column)) if model else np.zeros(len(column)), pa.float64())

    python_ready(described.sparkSession)
    return described.withColumn(out, run(F.col("statistics")))
