"""Small table operators: ranges, projections, counts, group means and top groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playtide.session import cut


def between_open(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows with ``low < column < high``; both ends and nulls are out."""
    return df.where((F.col(column) > low) & (F.col(column) < high))


def project(df: DataFrame, columns: Sequence[str], rename: dict[str, str] | None = None,
            kind: str = "string") -> DataFrame:
    """Named columns in order; unknown names become null columns of type ``kind``."""
    rename = rename or {}
    return df.select(*[
        (F.col(c) if c in df.columns else F.lit(None).cast(kind)).alias(rename.get(c, c))
        for c in columns])


def columns_from(df: DataFrame, first: str) -> DataFrame:
    """All columns from ``first`` to the end."""
    return df.select(*df.columns[df.columns.index(first):])


def where_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where none of ``columns`` is null or NaN."""
    return df.na.drop(subset=list(columns))


def last_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The last ``n`` rows under ``order``; the first ones are ``orderBy().limit()``."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def most_common_first(counts: DataFrame, column: str) -> DataFrame:
    """Value counts, largest first, equal counts by value."""
    return counts.orderBy(F.desc("n"), column)


def profile_counts(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Distinct and non-null values of a column. Exact unless asked otherwise."""
    distinct = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(distinct.alias("distinct_values"), F.count(column).alias("values"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def group_means(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean of every column per non-null group; missing values do not count."""
    for c in by:
        df = df.where(F.col(c).isNotNull())
    return df.groupBy(*by).agg(*[F.avg(c).alias(c) for c in columns])


def top_groups(groups: DataFrame, value: str, k: int, key: str, ascending: bool = False) -> DataFrame:
    """The ``k`` groups with the largest (or smallest) value, equal values by key."""
    order = F.asc_nulls_last(value) if ascending else F.desc_nulls_last(value)
    return groups.orderBy(order, key).limit(k)


def by_value(df: DataFrame, column: str, ascending: bool = True, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sorted by one column, missing values last in both directions."""
    order = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
    return df.orderBy(order, *tiebreak)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row per key under ``order``.

    A rank filter, not ``dropDuplicates``, which keeps an arbitrary row. Copies are
    cut to one per key in every input partition before the shuffle.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(window))
            .where(F.col("_rn") == 1).drop("_rn"))


def number_rows(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """0-based positions over the whole table in ``order``, without a one-task window.

    The rows are range-partitioned and sorted, and written out once so that the
    partitioning is fixed. Each partition is then shifted by the number of rows
    before it, which takes one small row per partition.
    """
    spread = cut(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    part, local = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = spread.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    # One row per partition of the sort: bounded by the shuffle partition setting.
    return (spread.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + local).drop("_part", "_start", "_id"))


def label_codes(df: DataFrame, column: str, code: str) -> DataFrame:
    """Each distinct non-null value with its 0-based rank in code-point order."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return number_rows(values, [column], code)


def label_encode(df: DataFrame, column: str, code: str) -> DataFrame:
    """Rows with the code of their value; rows without a value keep a null code and are not shuffled."""
    codes = label_codes(df, column, code)
    coded = df.where(F.col(column).isNotNull()).join(codes, column)
    without = df.where(F.col(column).isNull()).withColumn(code, F.lit(None).cast(codes.schema[code].dataType))
    return coded.unionByName(without)


def stack_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name, missing ones null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
