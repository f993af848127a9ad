"""Profiles against numpy and pandas on small tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skylag.operators import profile
from skylag.operators.quantiles import bounded_ranks, box_summary, quantiles
from skylag.operators.row_ids import with_row_id


@pytest.fixture(scope="module")
def frame():
    draw = np.random.default_rng(3)
    table = pd.DataFrame(
        {
            "g": draw.choice(["hot", "hot", "hot", "a", "b"], 400),
            "x": draw.normal(1e6, 3, 400),
            "y": draw.integers(0, 30, 400).astype(float),
            "z": np.full(400, 7.0),
        }
    )
    table["w"] = table.x * 2 + table.y
    table.loc[draw.choice(400, 60, replace=False), "y"] = np.nan
    table.loc[draw.choice(400, 30, replace=False), "w"] = np.nan
    return table


@pytest.fixture(scope="module")
def df(spark, frame):
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, "g string, x double, y double, z double, w double").repartition(5)


def test_correlations(df, frame):
    want = frame[["x", "y", "z", "w"]].corr()
    rows = profile.correlations(df, ["x", "y", "z", "w"]).collect()
    assert len(rows) == 16
    for r in rows:
        value = want.loc[r.column_a, r.column_b]
        assert r.r is None if np.isnan(value) else r.r == pytest.approx(value, abs=1e-9)


def test_histograms_follow_numpy(df, frame):
    rows = profile.histograms(df, ["x", "y", "z", "w"], 50).collect()
    for name in ("x", "y", "z", "w"):
        counts, edges = np.histogram(frame[name].dropna(), 50)
        mine = sorted((r for r in rows if r.column_name == name), key=lambda r: r.bin)
        assert [r.n for r in mine] == list(counts)
        assert [r.bin_low for r in mine] == pytest.approx(list(edges[:-1]))
        assert mine[-1].bin_high == pytest.approx(edges[-1])


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    df = spark.createDataFrame([(1,), (2,), (11,), (11,), (None,)], "v int")
    rows = sorted(profile.histogram(df, "v", 5).collect())
    assert [r.n for r in rows] == [2, 0, 0, 0, 2]
    assert (rows[0].bin_low, rows[-1].bin_high) == (1.0, 11.0)


def test_histogram_of_a_constant(spark):
    rows = profile.histogram(spark.createDataFrame([(4,), (4,)], "v int"), "v", 3).collect()
    assert sum(r.n for r in rows) == 2


@pytest.mark.parametrize("value", ["x", "y", "z"])
@pytest.mark.parametrize("most", [1, 7])
def test_quantiles(df, frame, value, most):
    probabilities = {"p10": 0.1, "median": 0.5, "p99": 0.99}
    rows = quantiles(df, value, probabilities, ["g"], most).collect()
    assert len(rows) == 3
    for r in rows:
        values = frame[frame.g == r.g][value].dropna()
        assert r.n == len(values)
        assert [r.p10, r.median, r.p99] == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.99])))


def test_box_summary(df, frame):
    for r in box_summary(df, "g", "y").collect():
        values = frame[frame.g == r.g].y.dropna()
        q1, q3 = np.quantile(values, [0.25, 0.75])
        inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        assert (r.whisker_low, r.whisker_high) == (inside.min(), inside.max())
        assert r.outliers == len(values) - len(inside)


def test_null_report(df, frame):
    got = {r.feature_name: (r.null_count, r.null_percent) for r in profile.null_report(df).collect()}
    assert got == {c: (frame[c].isna().sum(), round(frame[c].isna().mean() * 100, 2)) for c in frame}


def test_null_report_of_no_rows(df):
    assert {r.null_percent for r in profile.null_report(df.filter("false")).collect()} == {None}


def test_share_and_summary(df, frame):
    rows = profile.share(df, "g").collect()
    assert [r.g for r in rows] == list(frame.g.value_counts().index)
    assert sum(r.percent for r in rows) == pytest.approx(100)
    got = {r.column_name: r.median for r in profile.summary(df, ["x", "y"]).collect()}
    assert got == {name: pytest.approx(frame[name].median()) for name in ("x", "y")}


def test_row_ids_do_not_hang_on_partitions(spark):
    df = spark.range(0, 3000, 3).toDF("key")
    one, other = (with_row_id(df.repartition(n), "key", parts=n) for n in (3, 11))
    want = [(i * 3, i) for i in range(1000)]
    assert sorted(map(tuple, one.collect())) == want == sorted(map(tuple, other.collect()))


@pytest.fixture(scope="module")
def many_values(spark):
    """200,000 different values in one group, half of all rows at three values in the other."""
    draw = np.random.default_rng(8)
    values = pd.DataFrame(
        {
            "g": np.repeat(["wide", "ties"], 200_000),
            "v": np.concatenate(
                [
                    draw.standard_cauchy(200_000) * 10.0 ** draw.integers(-200, 200, 200_000),
                    np.where(draw.random(200_000) < 0.5, draw.integers(0, 3, 200_000), draw.normal(size=200_000)),
                ]
            ),
        }
    )
    return values, spark.createDataFrame(values).repartition(9)


@pytest.mark.parametrize("most", [1, 300])
def test_quantiles_of_many_values(many_values, most):
    frame, df = many_values
    probabilities = {"least": 0.0, "p1": 0.01, "median": 0.5, "p80": 0.8, "greatest": 1.0}
    for r in quantiles(df, "v", probabilities, ["g"], most).collect():
        values = np.sort(frame[frame.g == r.g].v)
        want = np.quantile(values, list(probabilities.values()))
        assert [r[name] for name in probabilities] == pytest.approx(list(want), rel=1e-12)


def test_only_bounded_intervals_are_sorted(many_values):
    """What is left to sort does not hang on the number of values."""
    frame, df = many_values
    rows = df.select("g", "v")
    ranks = rows.groupBy("g").agg(F.count("*").alias("n")).selectExpr("g", "n", "explode(array(0L, 99999L, 150000L)) AS rank")
    for r in bounded_ranks(rows, ranks, ["g"], 500).collect():
        values = np.sort(frame[frame.g == r.g].v)
        if r.found is not None:
            assert values[r.rank] == r.found
            continue
        low, high = -np.inf if r.low is None else r.low, np.inf if r.high is None else r.high
        assert r.inside <= 500
        assert r.inside == ((values > low) & (values < high)).sum()
        assert r.before == (values <= low).sum() and r.before <= r.rank < r.before + r.inside


def test_quantiles_of_odd_groups(spark):
    rows = [(None, 1.0), ("a", None), ("b", 5.0), ("b", float("inf")), ("b", 5.0), ("c", -0.0), ("c", 0.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.n, r.m) for r in quantiles(df, "v", {"m": 0.5}, ["g"], 1).collect()}
    assert got == {"b": (3, 5.0), "c": (2, 0.0)}
    assert quantiles(df.filter("g = 'x'"), "v", {"m": 0.5}, ["g"]).count() == 0


def test_correlations_of_large_values_in_one_scan(spark):
    draw = np.random.default_rng(4)
    small = draw.normal(size=(5000, 2))
    frame = pd.DataFrame({"a": 1e9 + small[:, 0], "b": 1e9 + small[:, 0] + 0.1 * small[:, 1], "c": -1e9 + small[:, 1]})
    df = spark.createDataFrame(frame).repartition(7)
    found = profile.correlations(df)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    want = (frame - [1e9, 1e9, -1e9]).corr()
    for r in found.collect():
        assert r.r == pytest.approx(want.loc[r.column_a, r.column_b], abs=1e-7)


def test_correlations_of_odd_columns(spark):
    rows = [(1.0, 2.0, 5.0, None, float("inf")), (2.0, float("nan"), 5.0, None, 1.0), (3.0, 7.0, 5.0, None, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    got = {(r.column_a, r.column_b): r.r for r in profile.correlations(df).collect()}
    assert got["a", "a"] == pytest.approx(1) and got["a", "b"] == pytest.approx(1)
    assert {got[pair] for pair in got if set(pair) & set("cde")} == {None}
    assert {r.r for r in profile.correlations(df.filter("a > 9")).collect()} == {None}
