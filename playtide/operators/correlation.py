"""Pearson correlations per group, in one pass over the rows, and as a matrix, in two."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.functions import safe_corr


_PLAIN_PAIRS = 16  # summed at once in the matrix
_MASKED_PAIRS = 4
_CELLS = "column_x string, column_y string, corr double"


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of numbers, decimals and booleans included."""
    return [f.name for f in df.schema
            if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in exclude]


def group_correlations(df: DataFrame, by: str, target: str, columns: Sequence[str] | None = None,
                       prefix: str | None = None) -> DataFrame:
    """Correlation of ``target`` with every column per group, one row per group.

    Only moments are shuffled: one small row per group and input partition.
    """
    columns = numeric_columns(df, [by]) if columns is None else columns
    prefix = f"corr_{target}_" if prefix is None else prefix
    return (df.where(F.col(by).isNotNull()).groupBy(by)
            .agg(*[safe_corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(prefix + c)
                   for c in columns]))


def code_correlations(df: DataFrame, by: str, target: str, value: str, codes: DataFrame, code: str,
                      name: str) -> DataFrame:
    """Correlation per group of ``target`` with the code of ``value``, as ``by, name``.

    The code is the same for all rows of a value, so rows are reduced to the moments of
    ``target`` per group and value before the codes are joined: no row meets the join, and a
    value with most of the rows is one row per group there.
    """
    rows = df.where(F.col(by).isNotNull() & F.col(value).isNotNull() & F.col(target).isNotNull())
    number = F.col(target).cast("double")
    parts = rows.groupBy(by, value).agg(
        F.count(F.lit(1)).alias("n"), F.avg(number).alias("mean"), F.var_pop(number).alias("spread"),
        F.min(number).alias("low"), F.max(number).alias("high"))
    coded = parts.join(codes, value).select(by, "n", "mean", "spread", "low", "high",
                                            F.col(code).cast("double").alias("code"))

    def mean(column: str) -> Column:
        return F.sum(F.col("n") * F.col(column)) / F.sum("n")

    centres = coded.groupBy(by).agg(mean("mean").alias("mean_all"), mean("code").alias("code_all"))
    a, b = F.col("mean") - F.col("mean_all"), F.col("code") - F.col("code_all")
    sums = coded.join(centres, by).groupBy(by).agg(
        F.sum(F.col("n") * a * b).alias("ab"), F.sum(F.col("n") * (F.col("spread") + a * a)).alias("aa"),
        F.sum(F.col("n") * b * b).alias("bb"), (F.min("low") < F.max("high")).alias("a_varies"),
        (F.min("code") < F.max("code")).alias("b_varies"))
    corr = F.when(F.col("a_varies") & F.col("b_varies"), F.col("ab") / F.sqrt("aa") / F.sqrt("bb"))
    return sums.select(by, corr.alias(name))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None,
                       method: str = "pearson") -> DataFrame:
    """``column_x, column_y, corr`` over all pairs, each over the rows where both are there.

    Two passes. The first one, run when this is called, finds count, mean and ends of every column.
    The second one sums products of the centred and scaled values: sums alone for a pair of columns
    without missing values, whose other moments are those of the columns; a pair with
    missing values takes its moments over the rows that have both. Pairs are summed in tiles,
    a few to a row, which keeps the compiled code small.
    """
    if method != "pearson":
        raise ValueError(f"unknown correlation method {method!r}")
    columns = numeric_columns(df) if columns is None else list(columns)
    if not columns:
        return df.sparkSession.createDataFrame([], _CELLS)
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    facts = _column_facts(values, len(columns))
    whole = {i for i, f in facts.items() if f["n"] == f["rows"]}
    scaled = values.select(*[
        ((F.col(f"c{i}") - f["mean"]) / F.lit(f["scale"])).alias(f"c{i}") for i, f in sorted(facts.items())])
    pairs = [(x, y) for x in range(len(columns)) for y in range(x, len(columns))]
    plain = [p for p in pairs if whole.issuperset(p)]
    masked = [p for p in pairs if not whole.issuperset(p)]
    cells = []
    if plain:
        sums = _tiled(scaled, plain, _PLAIN_PAIRS, lambda x, y: {"x": F.sum(x), "xy": F.sum(x * y)})
        varies = {x: facts[x]["n"] > 0 and facts[x]["low"] != facts[x]["high"] for x in whole}

        def product(x: int, y: int) -> float:
            """The sum of products about the means; values were centred only as well as a mean can be written."""
            return sums[(x, y)]["xy"] - sums[(x, x)]["x"] * sums[(y, y)]["x"] / facts[x]["n"]

        for x, y in plain:
            defined = varies[x] and varies[y]
            cells.append((x, y, product(x, y) / (product(x, x) ** 0.5 * product(y, y) ** 0.5) if defined else None))
    if masked:
        def moments(x: Column, y: Column) -> dict[str, Column]:
            x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
            return {"n": F.count(x), "x": F.sum(x), "y": F.sum(y), "xx": F.sum(x * x), "yy": F.sum(y * y),
                    "xy": F.sum(x * y), "x0": F.min(x), "x1": F.max(x), "y0": F.min(y), "y1": F.max(y)}

        for (x, y), m in _tiled(scaled, masked, _MASKED_PAIRS, moments).items():
            corr = None
            if m["n"] and m["x0"] != m["x1"] and m["y0"] != m["y1"]:
                xx, yy = m["xx"] - m["x"] * m["x"] / m["n"], m["yy"] - m["y"] * m["y"] / m["n"]
                corr = (m["xy"] - m["x"] * m["y"] / m["n"]) / (xx ** 0.5 * yy ** 0.5) if xx > 0 and yy > 0 else None
            cells.append((x, y, corr))
    rows = []
    for x, y, corr in cells:
        corr = None if corr is None else 1.0 if x == y else corr if corr != corr else max(-1.0, min(1.0, corr))
        rows += [(columns[x], columns[y], corr)] + [(columns[y], columns[x], corr)] * (x != y)
    return df.sparkSession.createDataFrame(rows, _CELLS)


def _column_facts(values: DataFrame, n: int) -> dict[int, dict[str, float]]:
    """Per column: rows, values, least and greatest one, mean, and their distance as a scale."""
    long = values.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("v")) for i in range(n)])))
    facts = {i: {"rows": 0, "n": 0, "mean": 0.0, "scale": 1.0, "low": None, "high": None} for i in range(n)}
    for r in long.groupBy("i").agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("n"), F.avg("v").alias("mean"),
                                   F.min("v").alias("low"), F.max("v").alias("high")).collect():
        span = (r.high - r.low) if r.n else 0.0
        finite = r.n and abs(r.mean) < float("inf") and 0 < span < float("inf")
        facts[r.i] = {"rows": r["rows"], "n": r.n, "low": r.low, "high": r.high,
                      "mean": r.mean if finite else 0.0, "scale": span if finite else 1.0}
    return facts


def _tiled(values: DataFrame, pairs: list[tuple[int, int]], size: int,
           moments: Callable[[Column, Column], dict[str, Column]]) -> dict[tuple[int, int], dict[str, float]]:
    """Moments of every pair in one pass: few of them at once, else a row per tile of pairs and input row."""
    tiles = [pairs[i:i + size] for i in range(0, len(pairs), size)]
    if len(tiles) == 1:
        rows = values.select(F.lit(0).alias("tile"), "*")
        sides = [(F.col(f"c{x}"), F.col(f"c{y}")) for x, y in pairs]
    else:
        nothing = F.lit(None).cast("double")
        rows = values.select(F.inline(F.array(*[F.struct(F.lit(t).alias("tile"), *[
            side.alias(f"{name}{i}") for i in range(size)
            for name, side in zip("xy", (F.col(f"c{c}") for c in tile[i]) if i < len(tile) else (nothing, nothing))])
            for t, tile in enumerate(tiles)])))
        sides = [(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(size)]
    sums = [value.alias(f"{name}_{i}") for i, (x, y) in enumerate(sides) for name, value in moments(x, y).items()]
    names = list(moments(*sides[0]))
    found = {r.tile: r for r in rows.groupBy("tile").agg(*sums).collect()}
    return {pair: {name: found[t][f"{name}_{i}"] if t in found else None for name in names}
            for t, tile in enumerate(tiles) for i, pair in enumerate(tile)}
