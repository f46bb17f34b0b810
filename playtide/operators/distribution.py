"""Distribution of a numeric column: histogram, density curve, box summary, point pairs."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.operators.quantiles import group_quantiles

# Beyond this many bandwidths a Gaussian weight is 0 in double precision.
_REACH = 39
# Cells per bandwidth, and moments kept of each: the series of the kernel around a cell's
# centre then leaves less than 1e-12 of one value's weight.
_CELLS, _MOMENTS = 2, 15


def _values(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("double")
    return df.select(value.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are listed too.

    A constant column gets bins over one unit around its value.
    """
    values = _values(df, column)
    span = F.struct(F.min("value").alias("low"), F.max("value").alias("high"))
    limits = values.agg(span.alias("span")).scalar()

    def edge(end: str, shift: float) -> Column:
        return F.when(limits["low"] == limits["high"], limits["low"] + shift).otherwise(limits[end])

    low, high = edge("low", -0.5), edge("high", 0.5)
    place = F.least(F.floor((F.col("value") - low) / (high - low) * bins), F.lit(bins - 1))
    counts = values.groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / bins
    return every.join(counts, "bin", "left").select(
        "bin", (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def density(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian density estimate on an even grid over [min, max], Scott's bandwidth.

    Values are summed up in cells of half a bandwidth, as moments of their distance from the
    cell's centre, inside every input partition. What is shuffled is one row per cell and
    partition. The kernel around a centre is a series in those moments (Hermite polynomials),
    which is evaluated for the grid points within reach. A constant column has null densities.
    """
    values = _values(df, column)
    m = values.agg(F.struct(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"),
        F.stddev_samp("value").alias("spread")).alias("m")).scalar()
    step = (m["high"] - m["low"]) / (points - 1)
    width = F.nullif(m["spread"] * F.pow(m["n"].cast("double"), F.lit(-0.2)), F.lit(0.0))
    z = (F.col("value") - m["low"]) / width
    cells = (values.select(F.floor(z * _CELLS).alias("cell"), z.alias("z")).where("cell is not null")
             .select("cell", (F.col("z") - (F.col("cell") + 0.5) / _CELLS).alias("u"))
             .groupBy("cell").agg(*[F.sum(F.pow("u", F.lit(float(k)))).alias(f"m{k}") for k in range(_MOMENTS)])
             .withColumn("centre", (F.col("cell") + 0.5) / _CELLS)
             .withColumn("block", F.floor(F.col("centre") / _REACH)))
    grid = df.sparkSession.range(points).select(
        F.col("id").alias("point"), (m["low"] + F.col("id") * step).alias("x"),
        (F.col("id") * step / width).alias("place"))
    # A point is reached from its own block of _REACH bandwidths and the two beside it.
    blocks = [grid.select("point", "place", (F.floor(F.col("place") / _REACH) + side).alias("block"))
              for side in (-1, 0, 1)]
    t = F.col("place") - F.col("centre")
    reached = blocks[0].union(blocks[1]).union(blocks[2]).join(cells, "block").select(
        "point", t.alias("t"), *[f"m{k}" for k in range(_MOMENTS)])
    terms = reached.withColumns({"h0": F.lit(1.0), "h1": F.col("t")})  # Hermite polynomials of t
    for k in range(2, _MOMENTS):
        terms = terms.withColumn(f"h{k}", F.col("t") * F.col(f"h{k - 1}") - (k - 1) * F.col(f"h{k - 2}"))
    series = F.lit(0.0)
    for k in range(_MOMENTS):
        series = series + F.col(f"h{k}") * F.col(f"m{k}") / math.factorial(k)
    sums = terms.groupBy("point").agg(F.sum(F.exp(-0.5 * F.col("t") * F.col("t")) * series).alias("sum"))
    norm = m["n"] * width * math.sqrt(2 * math.pi)
    return grid.join(sums, "point", "left").select(
        F.col("point").cast("int").alias("point"), "x",
        F.try_divide(F.coalesce("sum", F.lit(0.0)), norm).alias("density"))


def box_summary(df: DataFrame, column: str, by: Sequence[str] = (), stored: bool = False) -> DataFrame:
    """Quartiles, whiskers (extreme values within 1.5 times the quartile range), outliers.

    ``stored`` rows are cheap to read again, so they are not written out for the quartiles.
    """
    by = list(by)
    number = F.col(column).cast("double")
    rows = df.select(*by, number.alias("value")).where(number.isNotNull() & ~F.isnan(number))
    boxes = group_quantiles(rows, by, ["value"], {"~q1": 0.25, "~q2": 0.5, "~q3": 0.75}, stored)
    boxes = boxes.select(*by, *[F.col(f"`value~{q}`").alias(q) for q in ("q1", "q2", "q3")])
    if by:
        rows = rows.join(boxes, by)
    else:
        box = boxes.first()  # three numbers, which exact_quantiles has found already
        rows = rows.select("value", *[F.lit(box and box[q]).cast("double").alias(q) for q in ("q1", "q2", "q3")])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    near = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return rows.groupBy(*by, "q1", "q2", "q3").agg(
        F.min(F.when(near, F.col("value"))).alias("whisker_low"),
        F.max(F.when(near, F.col("value"))).alias("whisker_high"),
        F.count_if(~near).alias("outliers"), F.count("*").alias("n"))


def point_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """Points of a scatter plot: rows where both coordinates are there."""
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)


def pair_plot_points(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Points of a pair plot: one row per point with all coordinates."""
    return df.select(*columns)
