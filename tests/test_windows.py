"""Window means against a join written out in plain Python."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Row

from skylag.functions.blocks import TIME_BLOCKS, block_bounds
from skylag.operators.windows import label_window_means, requested_windows, window_means

from skylag.plans.flight_weather import interval_join


def brute(observations, measures, blocks, hours, days):
    means = {}
    for station in {o[0] for o in observations}:
        for day in days:
            midnight = datetime.combine(day, datetime.min.time())
            for code, block in enumerate(blocks):
                begin, end = block_bounds(block)
                low = midnight + timedelta(minutes=begin - 60 * hours)
                high = midnight + timedelta(minutes=end - 60)
                seen = [o for o in observations if o[0] == station and low <= o[1] <= high]
                if not seen:
                    continue
                found = [len(seen)]
                for i in range(measures):
                    values = [o[2 + i] for o in seen if o[2 + i] is not None]
                    found.append(sum(values) / len(values) if values else None)
                means[(station, day, code)] = tuple(found)
    return means


def check(spark, observations, blocks=TIME_BLOCKS, hours=10, kind="timestamp_ntz"):
    df = spark.createDataFrame(observations, f"station int, date {kind}, a double, b double")
    rows = window_means(df, ["a", "b"], blocks, hours).collect()
    got = {(r.station, r.window_day, r.block): (r.n_obs, r.a, r.b) for r in rows}
    first = min(o[1] for o in observations).date() - timedelta(days=3)
    days = [first + timedelta(days=i) for i in range(12)]
    want = brute(observations, 2, blocks, hours, days)
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values)


def check_labels(spark, observations, labels, hours=10, kind="timestamp_ntz"):
    """Windows that are asked for, whatever their labels, against the same plain join."""
    df = spark.createDataFrame(observations, f"station int, date {kind}, a double, b double")
    first = min(o[1] for o in observations).date() - timedelta(days=3)
    days = [first + timedelta(days=i) for i in range(9)]
    asked = [(s, d, label) for s in (0, 1, 2, 7) for d in days for label in labels] * 2
    requests = spark.createDataFrame(asked, "station int, day date, label string")
    rows = label_window_means(df, requested_windows(requests, hours), ["a", "b"]).collect()
    got = {(r.station, r.day, r.label): (r.n_obs, r.a, r.b) for r in rows}
    assert len(got) == len(rows)
    want = brute(observations, 2, labels, hours, days)
    want = {(s, d, labels[code]): v for (s, d, code), v in want.items()}
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values)


def scatter(seed, n):
    draw = random.Random(seed)
    start = datetime(2024, 1, 5)
    return [
        (
            draw.randrange(3),
            start + timedelta(minutes=draw.randrange(3 * 1440), microseconds=draw.choice([0, 1, 59_999_999])),
            draw.choice([None, float(draw.randrange(100))]),
            float(draw.randrange(100)),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("hours", [1, 10, 30])
def test_random_observations(spark, hours):
    check(spark, scatter(hours, 200), hours=hours)


def test_other_blocks_with_marks_inside_the_hour(spark):
    check(spark, scatter(5, 200), blocks=["0015-0545", "0630-0714", "0715-2359"], hours=4)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_both_ends_are_inside(spark, kind):
    noon = datetime(2024, 1, 5, 12)
    moments = [
        noon - timedelta(hours=10, microseconds=1),
        noon - timedelta(hours=10),
        noon - timedelta(minutes=1),
        noon - timedelta(minutes=1, microseconds=-1),
        datetime(2024, 1, 4, 14, 0, 59, 999_999),
        datetime(2024, 1, 4, 14, 1),
    ]
    check(spark, [(1, at, float(i), 1.0) for i, at in enumerate(moments)], kind=kind)


def test_one_station_with_most_observations(spark):
    hot = [(7, at, a, b) for _, at, a, b in scatter(9, 400)]
    check(spark, hot + scatter(10, 40))


def test_window_reaches_into_the_next_day(spark):
    rows = window_means(
        spark.createDataFrame(
            [(1, datetime(2024, 1, 5, 23, 30), 4.0)], "station int, date timestamp_ntz, a double"
        ),
        ["a"],
    ).collect()
    days = {r.window_day for r in rows}
    assert days == {date(2024, 1, 6)}
    # The night block, and the hours until nine.
    assert {r.block for r in rows} == {0, 1, 2, 3, 4}


ODD_LABELS = ["0715-0800", "0001-2359", "0003-0004", "1200-1200", "2359-0000", "0900-0959", "1017-1733"]


@pytest.mark.parametrize("hours", [0, 1, 10, 47])
def test_labels_of_any_kind(spark, hours):
    check_labels(spark, scatter(20 + hours, 300), ODD_LABELS, hours)


def test_both_forms_agree(spark):
    check(spark, scatter(31, 200))
    check_labels(spark, scatter(31, 200), TIME_BLOCKS)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_ends_of_any_label_are_inside(spark, kind):
    noon = datetime(2024, 1, 5, 12, 17)
    edges = [noon, noon - timedelta(hours=10)]
    moments = [e + timedelta(microseconds=d) for e in edges for d in (-1, 0, 1, 999_999)]
    check_labels(spark, [(1, at, float(i), 1.0) for i, at in enumerate(moments)], ["1217-1317"], kind=kind)


def test_one_station_day_with_most_observations(spark):
    hot = [(7, at, a, b) for _, at, a, b in scatter(9, 400)]
    check_labels(spark, hot + scatter(10, 40), ODD_LABELS[:3])


def test_labels_that_are_none_have_no_window(spark):
    asked = [(1, date(2024, 1, 5), label) for label in ("", None, "noon", "12", "1200", "ab00-1200")]
    requests = spark.createDataFrame(asked, "station int, day date, label string")
    assert requested_windows(requests).count() == 0
    seen = spark.createDataFrame([], "station int, date timestamp_ntz, a double")
    assert label_window_means(seen, requested_windows(requests), ["a"]).count() == 0


def interval_case(spark, flights, observations, columns):
    rows = [(k, s, date(2024, 1, 5), label) for k, s, label in flights]
    schema = "flight_id int, origin_station_id int, fl_date date, dep_time_blk string"
    df = spark.createDataFrame(rows, schema).selectExpr(
        "*", "origin_station_id AS dest_station_id", "dep_time_blk AS arr_time_blk"
    )
    seen = spark.createDataFrame(observations, "station int, date timestamp_ntz")
    found = interval_join(df, seen, "origin", columns=columns)
    joins = [n for n in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in n]
    assert len(joins) == 1
    return sorted(map(str, found.collect()))


@pytest.mark.parametrize("columns", [("flight_id",), ("fl_date",)])
def test_interval_rows_with_repeated_keys(spark, columns):
    labels = ["0600-0659", "1215-1230", "2300-0000", None, "x"]
    draw = random.Random(4)
    flights = [(draw.randrange(6), draw.choice([0, 1, 2, None]), draw.choice(labels)) for _ in range(40)]
    seen = [(s, at) for s, at, *_ in scatter(41, 60)]
    want = []
    for k, s, label in flights:
        key = k if columns == ("flight_id",) else date(2024, 1, 5)
        found = []
        if label and "-" in label:
            begin, end = block_bounds(label)
            midnight = datetime(2024, 1, 5)
            low, high = midnight + timedelta(minutes=begin - 600), midnight + timedelta(minutes=end - 60)
            found = [o for o in seen if o[0] == s and low <= o[1] <= high]
        want += [Row(**{columns[0]: key, "station": a, "date": b}) for a, b in found or [(None, None)]]
    assert interval_case(spark, flights, seen, columns) == sorted(map(str, want))
