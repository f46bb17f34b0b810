import random
import statistics

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playtide.operators import correlation, distribution, quantiles, tables
from playtide.plans import pipelines


@pytest.fixture(scope="module")
def catalogue(spark):
    random.seed(7)
    rows = []
    for i in range(4000):
        genre = random.choice(["hot"] * 6 + ["b", "c", None])
        # Values with many repeats, gaps and a far outlier.
        duration = random.choice([100_000.0, 350_000.0, None, random.uniform(5e4, 5e5), 1e7])
        rows.append((genre, duration, float(random.randrange(4)), random.gauss(0, 1), random.choice("Zabé")))
    rows.append(("one", 5.0, 1.0, 2.0, "a"))
    rows.append(("none", None, None, None, None))
    return spark.createDataFrame(rows, "genre string, duration double, popularity double, energy double, artists string").cache()


COLUMNS = ["duration", "popularity", "energy"]


def test_quantiles_agree_with_pandas(catalogue):
    frame = catalogue.toPandas()
    probabilities = {"_0": 0.0, "_1": 0.1, "_5": 0.5, "_9": 0.937, "_x": 1.0}
    got = quantiles.group_quantiles(catalogue, ["genre"], COLUMNS, probabilities).toPandas()
    got = got.set_index("genre").sort_index()
    assert list(got.index) == ["b", "c", "hot", "none", "one"]
    for suffix, p in probabilities.items():
        want = frame.groupby("genre")[COLUMNS].quantile(p).sort_index()
        for c in COLUMNS:
            np.testing.assert_allclose(got[c + suffix].astype(float), want[c], rtol=1e-12)


@pytest.mark.parametrize("bad_edges", [[0.0] * 4, [1.0] * 4, [0.1, 0.2, 0.3, 0.31]])
def test_quantiles_do_not_depend_on_the_sketch(catalogue, monkeypatch, bad_edges):
    original = F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx",
                        lambda c, edges, accuracy: original(c, bad_edges, 10))
    got = {r["genre"]: r["energy"] for r in quantiles.group_medians(
        catalogue, ["genre"], ["energy"]).collect()}
    want = catalogue.toPandas().groupby("genre")["energy"].median()
    assert got["hot"] == pytest.approx(want["hot"], rel=1e-12)
    assert got["b"] == pytest.approx(want["b"], rel=1e-12) and got["none"] is None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_median_of_any_list(spark, values):
    frame = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    got = quantiles.group_medians(frame, [], ["v"]).first()
    numbers = [float(v) for v in values if v is not None]
    if numbers:
        assert got["v"] == pytest.approx(statistics.median(numbers), rel=1e-9, abs=1e-9)
    else:
        assert got is None or got["v"] is None


def test_group_means_and_top_groups(catalogue):
    frame = catalogue.toPandas()
    means = tables.group_means(catalogue, ["genre"], COLUMNS)
    got = means.toPandas().set_index("genre").sort_index()
    want = frame.groupby("genre")[COLUMNS].mean().sort_index()
    np.testing.assert_allclose(got[COLUMNS].astype(float), want, rtol=1e-9)
    assert [r["genre"] for r in tables.top_groups(means, "popularity", 9, "genre").collect()][-1] == "none"
    assert tables.top_groups(means, "popularity", 1, "genre", ascending=True).first()["genre"] == \
        want["popularity"].idxmin()
    with pytest.raises(ValueError):
        pipelines.genre_profile(catalogue, COLUMNS, "mode")


def test_open_range(catalogue):
    kept = tables.between_open(catalogue, "duration", 100_000, 350_000).toPandas()["duration"]
    assert len(kept) and kept.min() > 100_000 and kept.max() < 350_000


def test_correlations_agree_with_pandas(catalogue):
    frame = catalogue.toPandas()
    matrix = correlation.correlation_matrix(catalogue, COLUMNS)
    got = {(r["column_x"], r["column_y"]): r["corr"] for r in matrix.collect()}
    want = frame[COLUMNS].corr()
    assert len(got) == 9
    for (x, y), value in got.items():
        assert value == pytest.approx(want.loc[x, y], abs=1e-9)
        assert got[(y, x)] == value
    groups = correlation.group_correlations(catalogue, "genre", "popularity", COLUMNS)
    table = {r["genre"]: r for r in groups.collect()}
    assert table["hot"]["corr_popularity_popularity"] == pytest.approx(1.0)
    hot = frame[frame.genre == "hot"]
    assert table["hot"]["corr_popularity_energy"] == pytest.approx(hot["energy"].corr(hot["popularity"]))
    assert table["one"]["corr_popularity_energy"] is None
    with pytest.raises(ValueError):
        correlation.correlation_matrix(catalogue, COLUMNS, method="pearsno")


def test_matrix_over_many_columns(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame(rng.normal(size=(300, 9)), columns=[f"c{i}" for i in range(9)])
    frame["c3"] = 1.0
    got = {(r[0], r[1]): r[2] for r in correlation.correlation_matrix(spark.createDataFrame(frame)).collect()}
    want = frame.corr()
    assert len(got) == 81
    for (x, y), value in got.items():
        assert (value is None and np.isnan(want.loc[x, y])) or value == pytest.approx(want.loc[x, y], abs=1e-9)


def test_popularity_correlations_encode_artists(catalogue):
    frame = catalogue.toPandas()
    codes = {a: i for i, a in enumerate(sorted(frame["artists"].dropna().unique()))}
    assert codes == {"Z": 0, "a": 1, "b": 2, "é": 3}
    got = {r["genre"]: r for r in pipelines.popularity_correlations(catalogue, COLUMNS).collect()}
    hot = frame[frame.genre == "hot"]
    want = hot["artists"].map(codes).corr(hot["popularity"])
    assert got["hot"]["corr_popularity_artists_id"] == pytest.approx(want)


def test_label_codes(spark):
    rows = spark.createDataFrame([("b",), ("é",), (None,), ("Z",), ("a",), ("b",)], "v string")
    assert {tuple(r) for r in tables.label_encode(rows, "v", "code").collect()} == {
        ("Z", 0), ("a", 1), ("b", 2), ("é", 3), (None, None)}


def test_number_rows_over_many_partitions(spark):
    rows = spark.range(5000).select(F.hash("id").alias("h"), "id").repartition(16)
    numbered = tables.number_rows(rows, ["h", "id"]).toPandas().sort_values(["h", "id"])
    assert list(numbered["position"]) == list(range(5000))


def test_histogram(spark):
    def bins(values, n):
        frame = spark.createDataFrame([(v,) for v in values], "v double")
        return [r["n"] for r in distribution.histogram(frame, "v", n).orderBy("bin").collect()]

    assert bins([0.0, 1.0, 9.9, 10.0, None, float("nan")], 5) == [2, 0, 0, 0, 2]
    assert bins([3.0, 3.0], 5) == list(np.histogram([3.0, 3.0], 5)[0])
    random.seed(1)
    values = [random.gauss(0, 3) for _ in range(500)]
    assert bins(values, 8) == list(np.histogram(values, 8)[0])


def test_density(spark):
    random.seed(2)
    values = [round(random.gauss(10, 3), 1) for _ in range(300)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = distribution.density(frame, "v", 50).orderBy("point").toPandas()
    x = np.linspace(min(values), max(values), 50)
    h = np.std(values, ddof=1) * len(values) ** -0.2
    want = np.exp(-0.5 * ((x[:, None] - np.array(values)) / h) ** 2).sum(1) / (len(values) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(got["x"], x)
    np.testing.assert_allclose(got["density"], want, rtol=1e-9)


def test_density_of_far_apart_and_constant_values(spark):
    frame = spark.createDataFrame([(float(v),) for v in [0, 0, 0, 1, 1, 2] * 500 + [10_000]], "v double")
    got = distribution.density(frame, "v", 200).orderBy("point").toPandas()
    assert len(got) == 200 and got["density"].iloc[0] > 0 and got["density"].iloc[100] == 0
    constant = distribution.density(frame.where("v = 1"), "v", 5).toPandas()
    assert len(constant) == 5 and constant["density"].isna().all() and (constant["x"] == 1).all()


def test_box_summary(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = distribution.box_summary(frame, "v").first()
    assert tuple(got) == (2.0, 3.0, 4.0, 1.0, 4.0, 1, 5)
    assert distribution.box_summary(frame.where("v > 1000"), "v").count() == 0


def test_counts(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("",)], "v string")
    counts = tables.most_common_first(tables.value_counts(rows, "v"), "v")
    assert [tuple(r) for r in counts.collect()] == [("b", 2), ("", 1), ("a", 1)]
    assert tuple(tables.profile_counts(rows, "v").first()) == (3, 4)
    assert tuple(tables.profile_counts(rows, "v", approximate=True).first()) == (3, 4)
    assert [r[0] for r in tables.distinct_values(rows.na.drop(), "v").collect()] == ["", "a", "b"]


def test_distribution_pipeline(catalogue):
    parts = pipelines.distribution_of(catalogue, "energy", 5, 20)
    total = catalogue.where("energy is not null").count()
    assert parts["histogram"].agg(F.sum("n")).first()[0] == total
    assert parts["density"].count() == 20 and parts["box"].first()["n"] == total


def test_points(catalogue):
    points = distribution.point_pairs(catalogue, "popularity", "duration")
    assert points.where("popularity is null or duration is null").count() == 0
    assert distribution.pair_plot_points(catalogue, COLUMNS).columns == COLUMNS


NUMBERS = [0.0, -0.0, 1.0, -1.0, 2.0 - 2 ** -52, 1.0 - 2 ** -53, 2 ** -1022, 2 ** -1074, 3 * 2 ** -1074, 2 ** -1022 - 2 ** -1074,
           1.7976931348623157e308, float("inf"), float("-inf"), 8.0, 8 - 2 ** -50, 1e300, 1e-300, 0.1, 1 / 3, 1e15 + 0.125]


@pytest.mark.parametrize("small", [1, 1000])
def test_quantiles_of_all_kinds_of_doubles(spark, monkeypatch, small):
    monkeypatch.setattr(quantiles, "_SMALL", small)
    values = NUMBERS + [-v for v in NUMBERS] + [random.Random(i).uniform(-1, 1) * 10.0 ** (i % 600 - 300) for i in range(200)]
    df = spark.createDataFrame([(v,) for v in [*values, float("nan"), None]], "v double").repartition(3)
    places = [0, 1, 3, 17, len(values) // 2, len(values) - 2, len(values) - 1]
    got = quantiles.exact_quantiles(df, [], ["v"], [p / (len(values) - 1) for p in places]).collect()
    ordered = sorted(values)
    found = sorted(r["value"] for r in got)
    assert len(found) == len(places)
    for value, place in zip(found, places):
        assert value == pytest.approx(ordered[place], rel=1e-12, abs=0)


@pytest.mark.parametrize("small", [1, 20])
def test_quantiles_digit_by_digit(spark, monkeypatch, small):
    """Ranges too large to be brought together are counted again by their next digits."""
    monkeypatch.setattr(quantiles, "_SMALL", small)
    rng = np.random.default_rng(3)
    close = 1.0 + rng.integers(0, 300, 800) * 2.0 ** -52  # neighbours in the last digit
    values = np.concatenate([close, -close, rng.normal(size=300) * 1e300, [5.0] * 400])
    rows = [(("hot", "b")[i % 7 == 0], float(v), None if i % 3 else float(i)) for i, v in enumerate(values)]
    frame = pd.DataFrame(rows, columns=["g", "v", "w"])
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(5)
    probabilities = {"_1": 0.1, "_2": 0.25, "_5": 0.5, "_7": 0.73, "_9": 0.999}
    for by in ([], ["g"]):
        got = quantiles.group_quantiles(df, by, ["v", "w"], probabilities).toPandas()
        for suffix, p in probabilities.items():
            for c in ("v", "w"):
                want = frame.groupby("g")[c].quantile(p) if by else pd.Series([frame[c].quantile(p)])
                have = got.set_index("g").sort_index()[c + suffix] if by else got[c + suffix]
                np.testing.assert_allclose(have.astype(float), want, rtol=1e-12)


def test_no_group_meets_in_one_task(spark):
    """What is shuffled for a group is one row per digit and input partition."""
    df = spark.range(200_000).select(F.lit("hot").alias("g"), (F.col("id") * 0.37).alias("v")).repartition(6)
    digit = quantiles._first_digit(F.col("v"), F.nullif(F.abs("v"), F.lit(0.0)), 0.37, 74_000.0)
    assert 500 < df.select(digit.alias("d")).distinct().count() <= 2 * quantiles._DIGITS + 3
    got = quantiles.group_medians(df, ["g"], ["v"]).first()["v"]
    assert got == pytest.approx(0.37 * 199_999 / 2)


def test_matrix_with_missing_values_and_wide_ranges(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame(rng.normal(size=(400, 6)), columns=list("abcdef"))
    frame["b"] = frame["a"] * 1e-5 + 1e9  # small spread far from zero
    frame["c"] = frame["c"] * 1e250
    frame.loc[::3, "d"] = None
    frame.loc[1::2, "e"] = None
    frame["f"] = np.where(frame["e"].notna(), 7.0, frame["f"])  # constant where e is there
    rows = spark.createDataFrame([tuple(None if x != x else float(x) for x in r) for r in frame.to_numpy()],
                                 "a double, b double, c double, d double, e double, f double").repartition(3)
    got = {(r[0], r[1]): r[2] for r in correlation.correlation_matrix(rows).collect()}
    scaled = frame.assign(c=frame["c"] / 1e250, b=(frame["b"] - 1e9))
    want = scaled.corr()
    assert got[("e", "f")] is None and got[("f", "e")] is None and got[("f", "f")] == 1.0
    for (x, y), value in got.items():
        if {x, y} != {"e", "f"}:
            assert value == pytest.approx(want.loc[x, y], abs=1e-9)


def test_matrix_of_nothing(spark):
    rows = spark.createDataFrame([], "a double, b int")
    assert sorted(map(tuple, correlation.correlation_matrix(rows).collect())) == [
        ("a", "a", None), ("a", "b", None), ("b", "a", None), ("b", "b", None)]
    assert correlation.correlation_matrix(rows, []).collect() == []
