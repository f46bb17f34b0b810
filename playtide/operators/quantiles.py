"""Exact interpolated quantiles by radix selection, without collecting a group in one task.

The wanted positions of a group are narrowed down digit by digit, for all groups and columns at once.
A digit only has to grow with the value:

1. the first digit is the sign and the logarithm, in ``_DIGITS`` steps between the smallest and the
   largest size in the column; one pass counts values by group, column and digit. Counts are added up
   before the shuffle, so a group with most of the rows is at most 4,100 rows per task and column;
2. the digit that holds a position becomes its range, with its exact ends; a range of equal
   values is an answer;
3. ranges of up to ``_SMALL`` values are brought together and sorted, which is a bounded list;
   larger ones are counted again by their next digit, the place between their ends in
   ``_DIGITS`` steps. A range spans less than one octave or step then, so five such digits reach
   the last bit of a double; more are only needed in columns that span over 2,000 octaves.

Nothing depends on a sketch or a sample.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playtide.session import work_path

_DIGITS = 2_048
_SMALL = 1_000
_LARGEST = sys.float_info.max
_TARGET = ["n", "probability", "end", "position", "fraction"]
_RANGE = ["low", "high", "before", "count"]


def exact_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], probabilities: Sequence[float],
                    stored: bool = False) -> DataFrame:
    """``by..., column, probability, value`` with linear interpolation; missing values left out.

    The rows are read three times or more: the values are written out once, unless they are
    ``stored`` already. The passes but the last run when this is called.
    """
    by = list(by)
    for c in by:
        df = df.where(F.col(c).isNotNull())
    numbers = [F.col(c).cast("double") for c in columns]
    rows = df.select(*by, *[F.when(~F.isnan(v), v).alias(c) for v, c in zip(numbers, columns)])
    if not stored:
        path = work_path(df.sparkSession, "quantile-values")
        rows.write.parquet(path)
        rows = df.sparkSession.read.schema(rows.schema).parquet(path)
    sizes = [F.nullif(F.least(F.abs(c), F.lit(_LARGEST)), F.lit(0.0)) for c in columns]
    ends = rows.agg(*[f(v).alias(f"{f.__name__}_{i}") for i, v in enumerate(sizes) for f in (F.min, F.max)]).first()
    values = rows.select(*by, F.inline(F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(c).alias("value"),
                 _first_digit(F.col(c), size, ends[f"min_{i}"], ends[f"max_{i}"]).alias("digit"))
        for i, (c, size) in enumerate(zip(columns, sizes))])))
    if not by:
        return _whole_table(values, columns, probabilities)
    targets = _materialised(_first_ranges(_digit_counts(values, [*by, "column"]), by, probabilities))
    values = values.where("value is not null").drop("digit")
    while True:
        most = targets.where("low < high").agg(F.max("count")).first()[0]
        if most is None or most <= _SMALL:
            break
        targets = _materialised(_narrowed(values, targets, by))
    found = targets.withColumn("found", F.col("low")) if most is None else _looked_up(values, targets, by)
    sides = found.groupBy(*by, "column", "probability").agg(
        F.max("fraction").alias("fraction"),
        *[F.max(F.when(F.col("end") == end, F.col("found"))).alias(end) for end in ("low", "high")])
    names = F.array(*[F.lit(c) for c in columns])
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("fraction")
    return sides.select(*by, F.get(names, F.col("column")).alias("column"), "probability",
                        F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(value).alias("value"))


def group_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], probabilities: dict[str, float],
                    stored: bool = False) -> DataFrame:
    """One row per group with a column ``<column><suffix>`` per suffix and probability."""
    long = exact_quantiles(df, by, columns, list(probabilities.values()), stored)
    wide = [F.max(F.when((F.col("column") == c) & (F.col("probability") == p), F.col("value")))
            .alias(f"{c}{suffix}") for c in columns for suffix, p in probabilities.items()]
    return long.groupBy(*by).agg(*wide)


def group_medians(df: DataFrame, by: Sequence[str], columns: Sequence[str], stored: bool = False) -> DataFrame:
    """Exact median of every column per group."""
    return group_quantiles(df, by, columns, {"": 0.5}, stored)


def _materialised(targets: DataFrame) -> DataFrame:
    path = work_path(targets.sparkSession, "quantile-ranges")
    targets.write.parquet(path)
    return targets.sparkSession.read.schema(targets.schema).parquet(path)


def _whole_table(values: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """The same without groups: digits and ranges are short lists, which the driver holds."""
    def counted(rows: DataFrame, key: str) -> dict[int, list[Row]]:
        found = rows.groupBy(key, "digit").agg(F.count("value").alias("n"), F.min("value").alias("low"),
                                               F.max("value").alias("high")).where("n > 0").collect()
        return {k: sorted((r for r in found if r[0] == k), key=lambda r: r.digit) for k in {r[0] for r in found}}

    def holding(digits: list[Row], before: int, position: int) -> tuple[float, float, int, int]:
        for r in digits:
            if position < before + r.n:
                return r.low, r.high, before, r.n
            before += r.n
        raise ValueError("position beyond the rows")

    first = counted(values, "column")
    total = {c: sum(r.n for r in digits) for c, digits in first.items()}
    places = {(c, position) for c, n in total.items() for p in probabilities
              for position in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
    ranges = {(c, position): holding(first[c], 0, position) for c, position in places}
    values = values.where("value is not null").drop("digit")
    while open_ := {(c, r[0], r[1]): r for (c, _), r in ranges.items() if r[0] < r[1]}:
        keys = list(open_)
        inside = [(F.col("column") == c) & F.col("value").between(low, high) for c, low, high in keys]
        number = reduce(lambda rest, i: rest.when(inside[i], F.lit(i)), range(1, len(keys)), F.when(inside[0], F.lit(0)))
        rows = values.select(number.alias("range"), "value").where("range is not null")
        if all(r[3] <= _SMALL for r in open_.values()):
            held: dict[int, list[float]] = {}
            for r in rows.collect():
                held.setdefault(r.range, []).append(r.value)
            held = {i: sorted(v) for i, v in held.items()}
            for place, (low, high, before, n) in ranges.items():
                if low < high:
                    value = held[keys.index((place[0], low, high))][place[1] - before]
                    ranges[place] = value, value, before, n
            break
        ends = F.array(*[F.struct(F.lit(low).alias("low"), F.lit(high).alias("high")) for _, low, high in keys])
        rows = rows.withColumn("end", F.get(ends, F.col("range")))
        digits = counted(rows.withColumn("digit", _next_digit(F.col("value"), F.col("end.low"), F.col("end.high"))), "range")
        for place, (low, high, before, n) in ranges.items():
            if low < high:
                ranges[place] = holding(digits[keys.index((place[0], low, high))], before, place[1])
    out = []
    for i, c in enumerate(columns):
        for p in probabilities:
            value = None
            if total.get(i):
                exact = p * (total[i] - 1)
                low, high = ranges[(i, math.floor(exact))][0], ranges[(i, math.ceil(exact))][0]
                value = low if low == high else low + (high - low) * (exact - math.floor(exact))
            out.append((c, float(p), value))
    return values.sparkSession.createDataFrame(out, "column string, probability double, value double")


def _first_digit(value: Column, size: Column, least: float | None, largest: float | None) -> Column:
    """Sign and logarithm of a value as a whole number, given the smallest and the largest size but 0."""
    if least is None:
        return F.when(value == 0, F.lit(0))
    low, high = math.log2(least), math.log2(largest)
    step = F.floor((F.log2(size) - (low - 1)) * (_DIGITS / (high - low + 2))).cast("int") + 1
    return F.when(value > 0, step).when(value < 0, -step).when(value == 0, F.lit(0))


def _next_digit(value: Column, low: Column, high: Column) -> Column:
    """The place between the ends of a range as a whole number."""
    # Halves, so that the distance of two large numbers is one, too; an infinite end stands apart.
    part = (value / 2 - low / 2) / (high / 2 - low / 2)
    return F.when(value == low, F.lit(0)).when(value == high, F.lit(_DIGITS)).otherwise(
        F.floor(F.nanvl(part, F.lit(0.5)) * _DIGITS).cast("int"))


def _digit_counts(values: DataFrame, group: list[str]) -> DataFrame:
    """Values per digit with their ends, and how many come before; some thousand digits per group at most."""
    order = W.partitionBy(*group).orderBy(F.asc_nulls_last("digit"))
    counts = values.groupBy(*group, "digit").agg(
        F.count("value").alias("count"), F.min("value").alias("low"), F.max("value").alias("high"))
    return (counts.withColumn("before", F.sum("count").over(
                order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("count")))


def _first_ranges(counts: DataFrame, by: list[str], probabilities: Sequence[float]) -> DataFrame:
    """The two positions around each quantile, each with the digit that holds it."""
    whole = F.sum("count").over(W.partitionBy(*by, "column"))
    low = F.col("exact").cast("bigint")
    ends = [F.struct(F.lit(end).alias("end"), position.alias("position"))
            for end, position in (("low", low), ("high", F.ceil("exact")))]
    targets = (counts.withColumn("n", whole)
               .withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
               .withColumn("exact", F.col("probability") * (F.col("n") - 1))
               .select("*", (F.col("exact") - F.floor("exact")).alias("fraction"), F.inline(F.array(*ends))))
    held = (F.col("before") <= F.col("position")) & (F.col("position") < F.col("before") + F.col("count"))
    return targets.where(held | (F.col("n") == 0)).select(*by, "column", *_TARGET, *_RANGE)


def _in_ranges(values: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """Values within the ranges of targets that are still open, with the range."""
    ranges = targets.where("low < high").select(*by, "column", "low", "high").distinct()
    return values.join(ranges, [*by, "column"]).where(F.col("value").between(F.col("low"), F.col("high")))


def _narrowed(values: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """Targets with the range of their next digit."""
    place = _next_digit(F.col("value"), F.col("low"), F.col("high"))
    digits = _in_ranges(values, targets, by).withColumn("digit", place).withColumnRenamed("low", "range").drop("high")
    counts = _digit_counts(digits, [*by, "column", "range"]).select(
        *by, "column", F.col("range").alias("low"), *[F.col(c).alias(f"next_{c}") for c in _RANGE])
    start = F.col("before") + F.col("next_before")
    held = (start <= F.col("position")) & (F.col("position") < start + F.col("next_count"))
    next_range = [(start if c == "before" else F.col(f"next_{c}")).alias(c) for c in _RANGE]
    return (targets.where("low < high").join(counts, [*by, "column", "low"]).where(held)
            .select(*by, "column", *_TARGET, *next_range).unionByName(_settled(targets)))


def _settled(targets: DataFrame) -> DataFrame:
    return targets.where("low = high or n = 0")


def _looked_up(values: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """Targets with the value found; the values of an open range are few by now."""
    lists = _in_ranges(values, targets, by).groupBy(*by, "column", "low").agg(
        F.sort_array(F.collect_list("value")).alias("list"))
    place = (F.col("position") - F.col("before")).cast("int")
    return (targets.where("low < high").join(lists, [*by, "column", "low"])
            .withColumn("found", F.get("list", place)).drop("list")
            .unionByName(_settled(targets).withColumn("found", F.col("low"))))
