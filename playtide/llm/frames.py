"""Small helpers that the text operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtide.session import work_path


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def all_columns(df: DataFrame) -> Column:
    """Every column of a row as one struct, whatever the columns are called."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def spread(spark: SparkSession) -> int:
    """How many partitions a shuffle of the session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back, so that it is made once."""
    path = work_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python workers at most ``rows`` rows at once in what runs inside: for rows of known, large size."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def python_ready(spark: SparkSession) -> SparkSession:
    """Let the Python workers of a local session import this library; a cluster ships it with the job."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def drawn_rows(df: DataFrame, count: int, sample: int, *key: str) -> DataFrame:
    """At most ``sample`` of ``count`` rows, those with the smallest hash of their key.

    The hash leaves about one and a half samples over all partitions before any are sorted,
    so that no task and not the driver gets a sample from each partition.
    """
    place = F.pmod(F.xxhash64(*key, F.lit("draw")), F.lit(1 << 40))
    few = df.where(place < F.lit(int(min(1.0, (1.5 * sample + 50) / max(count, 1)) * (1 << 40))))
    return few.orderBy(place, *key).limit(sample)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows that hold about ``limit`` bytes of ``column``; no row is cut."""
    for batch in batches:
        sizes = pc.binary_length(batch[column]).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            held += size or 0
            if held >= limit:
                yield batch.slice(start, row + 1 - start)
                start, held = row + 1, 0
        if start < len(sizes):
            yield batch.slice(start)


def map_texts(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
              column: str = "text") -> DataFrame:
    """``mapInArrow`` over batches of a few megabytes of text, so a worker's memory does not follow the row count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            yield function(batch)

    python_ready(df.sparkSession)
    return df.mapInArrow(run, schema)
