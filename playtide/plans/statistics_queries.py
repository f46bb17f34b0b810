"""Queries over the track catalogue: counts, means, medians, correlations, distributions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from playtide.operators import correlation, distribution, quantiles, tables
from playtide.plans import bindings as b
from playtide.plans import pipelines
from playtide.plans.registry import query

COLUMNS = ["popularity", *b.FEATURES]
# Open range of durations that the profile queries keep.
LOW, HIGH = 10_000, 60_000
_KEPT = f"{b.TRACKS}, kept AS (SELECT * FROM tracks WHERE duration > {LOW} AND duration < {HIGH})"


def _kept(spark, sf_dir):
    return tables.between_open(b.tracks(spark, sf_dir), "duration", LOW, HIGH)


def _rounded(df, columns, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


def _each(template: str, columns=COLUMNS) -> str:
    return ", ".join(template.format(c=c) for c in columns)


@query(f"SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem "
       f"WHERE l_extendedprice > {LOW} AND l_extendedprice < {HIGH}")
def range_filter(spark, sf_dir):
    rows = tables.between_open(b.table(spark, sf_dir, "lineitem"), "l_extendedprice", LOW, HIGH)
    return tables.project(rows, ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"])


@query(f"WITH {_KEPT} SELECT track_id AS _id, genre, duration, popularity, "
       "CAST(NULL AS VARCHAR) AS loudness FROM kept")
def projection(spark, sf_dir):
    return tables.project(_kept(spark, sf_dir), ["track_id", "genre", "duration", "popularity", "loudness"],
                          rename={"track_id": "_id"})


@query(f"WITH {_KEPT} SELECT genre, popularity, track_id, duration, tempo FROM kept")
def sorted_tracks(spark, sf_dir):
    rows = _kept(spark, sf_dir).select("genre", "popularity", "track_id", "duration", "tempo")
    return rows.orderBy("genre", "popularity")


@query("SELECT p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS artists_id, p_partkey FROM part")
def label_encode(spark, sf_dir):
    part = b.table(spark, sf_dir, "part").select("p_brand", "p_partkey")
    return tables.label_encode(part, "p_brand", "artists_id")


@query("SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS position "
       "FROM customer")
def number_rows(spark, sf_dir):
    rows = b.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return tables.number_rows(rows, ["c_acctbal", "c_custkey"])


def _means_sql(order: str, k: int, column: str) -> str:
    return (f"WITH {b.TRACKS} SELECT genre, round(avg({column}), 6) AS {column} FROM tracks "
            f"GROUP BY genre ORDER BY avg({column}) {order}, genre LIMIT {k}")


def _top_means(spark, sf_dir, column, k, ascending):
    means = tables.group_means(b.tracks(spark, sf_dir), ["genre"], [column])
    return _rounded(tables.top_groups(means, column, k, "genre", ascending), [column])


@query(_means_sql("DESC", 3, "tempo"))
def genre_mean_topk(spark, sf_dir):
    return _top_means(spark, sf_dir, "tempo", 3, ascending=False)


@query(_means_sql("ASC", 3, "duration"))
def genre_mean_bottomk(spark, sf_dir):
    return _top_means(spark, sf_dir, "duration", 3, ascending=True)


@query(f"WITH {_KEPT} SELECT genre, {_each('round(avg({c}), 6) AS {c}')} FROM kept GROUP BY genre")
def genre_mean_all(spark, sf_dir):
    return _rounded(pipelines.genre_profile(_kept(spark, sf_dir), COLUMNS), COLUMNS)


@query(f"WITH {_KEPT} SELECT genre, {_each('round(median({c}), 6) AS {c}')} FROM kept GROUP BY genre")
def genre_median_all(spark, sf_dir):
    return _rounded(pipelines.genre_profile(_kept(spark, sf_dir), COLUMNS, "median"), COLUMNS)


@query(f"WITH {b.TRACKS} SELECT genre, {_each('round(median({c}), 6) AS {c}')} FROM tracks GROUP BY genre")
def genre_median_large_groups(spark, sf_dir):
    return _rounded(quantiles.group_medians(b.tracks(spark, sf_dir), ["genre"], COLUMNS), COLUMNS)


_CODED = f"""{_KEPT},
codes AS (SELECT artists, row_number() OVER (ORDER BY artists) - 1 AS artists_id
          FROM (SELECT DISTINCT artists FROM kept)),
coded AS (SELECT * FROM kept JOIN codes USING (artists))"""
_CORR = "CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE round(corr({x}, {y}), 6) END"


@query(f"WITH {_CODED} SELECT genre, " + ", ".join(
    _CORR.format(x=c, y="popularity") + f" AS corr_popularity_{c}" for c in [*COLUMNS, "artists_id"])
    + " FROM coded GROUP BY genre")
def genre_correlations(spark, sf_dir):
    table = pipelines.popularity_correlations(_kept(spark, sf_dir), COLUMNS)
    return _rounded(table, table.columns[1:])


def _matrix_sql(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{x}' AS column_x, '{y}' AS column_y, {_CORR.format(x=x, y=y)} AS corr FROM {source}"
        for x in columns for y in columns)


@query(f"WITH {_KEPT} " + _matrix_sql("kept", COLUMNS))
def corr_matrix(spark, sf_dir):
    return _rounded(correlation.correlation_matrix(_kept(spark, sf_dir), COLUMNS), ["corr"])


@query(f"WITH {b.TRACKS}, promo AS (SELECT * FROM tracks WHERE genre = 'PROMO') "
       + _matrix_sql("promo", COLUMNS))
def corr_matrix_one_genre(spark, sf_dir):
    rows = tables.where_equal(b.tracks(spark, sf_dir), "genre", "PROMO")
    return _rounded(correlation.correlation_matrix(rows, COLUMNS), ["corr"])


@query("SELECT p_type, " + _CORR.format(x="p_size", y="p_retailprice") + " AS corr, "
       "CAST(NULL AS DOUBLE) AS constant FROM part GROUP BY p_type")
def corr_with_constant(spark, sf_dir):
    part = b.table(spark, sf_dir, "part").withColumn("one", F.lit(1.5))
    table = correlation.group_correlations(part, "p_type", "p_size", ["p_retailprice", "one"], prefix="")
    return table.select("p_type", F.round("p_retailprice", 6).alias("corr"), F.col("one").alias("constant"))


@query(f"WITH {b.TRACKS} SELECT genre, CAST(NULL AS DOUBLE) AS tenth, CAST(NULL AS DOUBLE) AS large, "
       "CAST(NULL AS DOUBLE) AS itself FROM tracks GROUP BY genre")
def corr_inexact_constant(spark, sf_dir):
    """Constants whose sums are not exact, over many partitions: undefined all the same."""
    rows = (b.tracks(spark, sf_dir).repartition(16).withColumn("tenth", F.lit(0.1))
            .withColumn("large", F.lit(123456.789)))
    table = correlation.group_correlations(rows, "genre", "popularity", ["tenth", "large"], prefix="")
    whole = correlation.correlation_matrix(rows, ["tenth", "large"]).where("column_x = column_y").agg(
        F.max("corr").alias("itself"))
    return table.select("genre", "tenth", "large", whole.scalar().alias("itself"))


_KINDS = """
k AS (SELECT *, CAST(l_extendedprice AS DOUBLE) AS price, l_quantity > 25 AS many FROM lineitem)"""


@query(f"WITH {_KINDS} " + " UNION ALL ".join(
    f"SELECT '{x}' AS column_x, '{y}' AS column_y, round(corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)), 6) AS corr FROM k"
    for x in ("price", "many", "l_discount") for y in ("price", "many", "l_discount")))
def corr_matrix_kinds(spark, sf_dir):
    """A decimal, a boolean and a double column."""
    rows = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), (F.col("l_quantity") > 25).alias("many"),
        "l_discount")
    return _rounded(correlation.correlation_matrix(rows), ["corr"])


@query("SELECT l_discount AS value, count(*) AS n FROM lineitem GROUP BY l_discount")
def value_counts_feature(spark, sf_dir):
    return tables.value_counts(
        b.table(spark, sf_dir, "lineitem").select(F.col("l_discount").alias("value")), "value")


@query(f"WITH {b.TRACKS} SELECT track_id, genre, duration FROM tracks WHERE danceability = 0")
def zero_feature(spark, sf_dir):
    return tables.where_equal(b.tracks(spark, sf_dir), "danceability", 0).select("track_id", "genre", "duration")


def _counts_sql(table: str, column: str) -> str:
    return (f"SELECT {column}, count(*) AS n FROM {table} WHERE {column} IS NOT NULL "
            f"GROUP BY {column}")


def _value_counts(name, table, column):
    @query(_counts_sql(table, column), name=name)
    def counts(spark, sf_dir):
        rows = b.table(spark, sf_dir, table)
        return tables.most_common_first(tables.value_counts(rows, column), column)


_value_counts("value_counts_playlist", "lineitem", "l_orderkey")
_value_counts("value_counts_album", "part", "p_name")
_value_counts("value_counts_owner", "orders", "o_custkey")
_value_counts("value_counts_genre", "part", "p_type")


@query("SELECT count(DISTINCT l_partkey) AS distinct_values, count(l_partkey) AS values FROM lineitem")
def distinct_tracks(spark, sf_dir):
    return tables.profile_counts(b.table(spark, sf_dir, "lineitem"), "l_partkey")


@query("SELECT DISTINCT p_type FROM part")
def distinct_genres(spark, sf_dir):
    return tables.distinct_values(b.table(spark, sf_dir, "part"), "p_type")


def _histogram_sql(table: str, column: str, bins: int, where: str = "TRUE") -> str:
    return f"""
WITH v AS (SELECT {column} AS x FROM {table} WHERE {where}),
r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
c AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin,
             count(*) AS n FROM v, r GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * (hi - lo) / {bins}, 4) AS low,
       round(lo + (g.bin + 1) * (hi - lo) / {bins}, 4) AS high, coalesce(n, 0) AS n
FROM generate_series(0, {bins - 1}) AS g(bin) CROSS JOIN r LEFT JOIN c ON c.bin = g.bin"""


@query(_histogram_sql("lineitem", "l_extendedprice", 8))
def histogram(spark, sf_dir):
    table = distribution.histogram(b.table(spark, sf_dir, "lineitem"), "l_extendedprice", 8)
    return _rounded(table, ["low", "high"], 4)


@query(_histogram_sql("lineitem", "l_extendedprice", 5, f"l_extendedprice > {LOW} AND l_extendedprice < {HIGH}"))
def histogram_in_range(spark, sf_dir):
    rows = tables.between_open(b.table(spark, sf_dir, "lineitem"), "l_extendedprice", LOW, HIGH)
    return _rounded(distribution.histogram(rows, "l_extendedprice", 5), ["low", "high"], 4)


def _density_sql(table: str, column: str) -> str:
    return f"""
WITH v AS (SELECT {column} AS x, count(*) AS w FROM {table} GROUP BY 1),
m AS (SELECT min({column}) AS lo, max({column}) AS hi, count({column}) AS n,
             stddev_samp({column}) * pow(count({column}), -0.2) AS h FROM {table})
SELECT CAST(g.i AS INTEGER) AS point, round(lo + g.i * (hi - lo) / 199, 4) AS x,
       round(sum(w * exp(-0.5 * pow((lo + g.i * (hi - lo) / 199 - x) / h, 2)))
             / (n * h * {math.sqrt(2 * math.pi)!r}), 10) AS density
FROM generate_series(0, 199) AS g(i) CROSS JOIN m CROSS JOIN v GROUP BY g.i, lo, hi, n, h"""


@query(_density_sql("lineitem", "l_extendedprice"))
def density(spark, sf_dir):
    curve = distribution.density(b.table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return curve.select("point", F.round("x", 4).alias("x"), F.round("density", 10).alias("density"))


def _box_sql(table: str, column: str, by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    join = f"JOIN q USING ({by})" if by else "CROSS JOIN q"
    key = f"{by}, " if by else ""
    return f"""
WITH q AS (SELECT {key}quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS q2,
                  quantile_cont({column}, 0.75) AS q3 FROM {table} {group}),
v AS (SELECT {key}{column} AS x, q1, q2, q3,
             {column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS near
      FROM {table} {join})
SELECT {key}round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3,
       min(x) FILTER (WHERE near) AS whisker_low, max(x) FILTER (WHERE near) AS whisker_high,
       count(*) FILTER (WHERE NOT near) AS outliers, count(*) AS n
FROM v GROUP BY {key}q1, q2, q3"""


@query(_box_sql("events", "value"))
def box_summary(spark, sf_dir):
    return _rounded(distribution.box_summary(b.table(spark, sf_dir, "events"), "value", stored=True), ["q1", "q2", "q3"])


@query(_box_sql("events", "value", "event_type"))
def box_summary_by_type(spark, sf_dir):
    boxes = distribution.box_summary(b.table(spark, sf_dir, "events"), "value", ["event_type"], stored=True)
    return _rounded(boxes, ["q1", "q2", "q3"])


@query("SELECT " + ", ".join(
    f"round(quantile_cont(value, {p}), 6) AS value_{n}" for n, p in (("min", 0), ("p01", 0.01), ("p50", 0.5), ("max", 1)))
    + " FROM events")
def quantiles_large_table(spark, sf_dir):
    table = quantiles.group_quantiles(
        b.table(spark, sf_dir, "events"), [], ["value"],
        {"_min": 0.0, "_p01": 0.01, "_p50": 0.5, "_max": 1.0}, stored=True)
    return _rounded(table, table.columns)


@query("SELECT o_custkey, round(quantile_cont(o_totalprice, 0.9), 4) AS o_totalprice_p90, "
       "round(quantile_cont(o_totalprice, 0.1), 4) AS o_totalprice_p10 FROM orders GROUP BY o_custkey")
def quantiles_many_groups(spark, sf_dir):
    table = quantiles.group_quantiles(b.table(spark, sf_dir, "orders"), ["o_custkey"], ["o_totalprice"],
                                      {"_p90": 0.9, "_p10": 0.1}, stored=True)
    return _rounded(table, table.columns[1:], 4)


@query(f"WITH {b.TRACKS} SELECT popularity, energy FROM tracks WHERE genre = 'SMALL'")
def point_pairs(spark, sf_dir):
    rows = tables.where_equal(b.tracks(spark, sf_dir), "genre", "SMALL")
    return distribution.point_pairs(rows, "popularity", "energy")


@query(f"WITH {b.TRACKS} SELECT {', '.join(COLUMNS)} FROM tracks WHERE genre = 'LARGE'")
def pair_plot(spark, sf_dir):
    rows = tables.where_equal(b.tracks(spark, sf_dir), "genre", "LARGE")
    return distribution.pair_plot_points(rows, COLUMNS)
