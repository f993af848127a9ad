"""What the plans look like: what is read, what is shuffled, what is broadcast."""

import re

import pytest

from skylag.operators.clean import clean_flights, clean_weather, us_weather
from skylag.operators.nearest import nearest_join
from skylag.plans import catalog, training
from skylag.plans import flight_weather as fw
from skylag.plans.catalog import QUERIES
from skylag.plans.flight_weather import flight_weather, nearest_stations
from skylag.session import scratch_path
from skylag.sources import derived
from skylag.sources.tables import broadcast_if_small, materialize, read_csv, write_parquet


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_region_filter_scans_once_and_pushes_the_boxes(spark, sf_dir):
    stored = materialize(derived.weather(spark, sf_dir), "weather")
    text = plan(us_weather(stored))
    assert text.count("FileScan") == 1
    assert "GreaterThan(latitude" in text or "latitude" in text.split("PushedFilters")[1]


def test_clean_flights_reads_only_what_it_needs(spark, sf_dir):
    stored = materialize(derived.flights(spark, sf_dir), "flights")
    text = plan(clean_flights(stored).select("flight_id", "arr_del15"))
    assert "Exchange" not in text
    assert "ReadSchema: struct<flight_id:bigint,arr_delay:bigint,cancelled:boolean,diverted:boolean>" in text
    assert "Not(EqualTo(diverted" in text.split("PushedFilters")[1]


def test_nearest_forms_no_pairs(spark, sf_dir):
    text = plan(nearest_join(derived.airports(spark, sf_dir), derived.stations(spark, sf_dir)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "WindowGroupLimit" in text


@pytest.mark.parametrize(
    "name", ["flight_weather", "nearest_station", "hist_all_numeric", "carrier_delay_box", "minmax_train"]
)
def test_no_python_workers_and_no_nested_loops(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_joins_beyond_the_broadcast_limit_can_be_split(spark, sf_dir):
    """Without broadcasts, each side of the weather joins is a sorted shuffle, the
    form in which adaptive execution splits a hot key; results stay the same."""
    flights = clean_flights(derived.flights(spark, sf_dir))
    nearest = nearest_stations(derived.airports(spark, sf_dir), derived.stations(spark, sf_dir))
    weather = clean_weather(derived.weather(spark, sf_dir))
    want = sorted(map(str, flight_weather(flights, nearest, weather).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = flight_weather(flights, nearest, weather)
        text = plan(merged)
        got = sorted(map(str, merged.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 2
    lines = text.splitlines()
    sorts = [i for i, line in enumerate(lines) if " Sort [" in line]
    assert all("Exchange hashpartitioning" in lines[i + 1] for i in sorts)
    assert got == want


def test_broadcast_only_after_a_count(spark):
    small, large = spark.range(10), spark.range(11)
    assert "ResolvedHint" in broadcast_if_small(small, 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(large, 10)._jdf.queryExecution().analyzed().toString()


def test_partitioned_sink_prunes_years(spark, sf_dir):
    path = scratch_path(spark, "pruned")
    write_parquet(clean_flights(derived.flights(spark, sf_dir)), path, ["year"])
    text = plan(spark.read.parquet(path).filter("year = 2001"))
    assert "PartitionFilters: [isnotnull(year" in text
    with pytest.raises(Exception, match="(?i)already exists"):
        write_parquet(spark.range(1).selectExpr("id AS year", "id"), path, ["year"])


def test_csv_with_given_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("airport_id;lat;lon\nAAA;1.5;-2\nBBB;;3\n")
    rows = read_csv(spark, str(tmp_path / "a.csv"), sep=";").collect()
    assert [tuple(r) for r in rows] == [("AAA", 1.5, -2.0), ("BBB", None, 3.0)]


def test_windows_read_flights_once(spark, sf_dir, monkeypatch):
    """Both airports' windows come from one scan, of the columns that they need."""
    written = []
    monkeypatch.setattr(fw, "materialize", lambda df, name, by=(): written.append(df) or df)
    windows = fw.windows_of(catalog._clean_flights(spark, sf_dir), catalog._nearest(spark, sf_dir))
    plan = written[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert windows.count() > 0 and plan.count("o_orderkey") > 0
    assert sum("Relation [o_" in line for line in plan.splitlines()) == 1


def test_used_stations_reach_the_scan_of_observations(spark, sf_dir, monkeypatch):
    """A few stations are pushed into the scan; many are joined, with the same rows."""
    weather = clean_weather(derived.weather(spark, sf_dir))
    nearest = catalog._nearest(spark, sf_dir)
    listed = fw.at_stations(weather, nearest)
    below = listed._jdf.queryExecution().optimizedPlan().toString().split("Generate")[-1]
    assert re.search(r"user_id#\d+L? (IN|INSET|=) ", below)
    monkeypatch.setattr(fw, "LISTED", 0)
    joined = fw.at_stations(weather, nearest)
    assert "Join" in joined._jdf.queryExecution().toString()
    assert sorted(map(str, listed.collect())) == sorted(map(str, joined.collect()))
    assert listed.count() > 0


def test_features_write_no_training_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(training, "materialize", lambda *_: pytest.fail("training rows were written"))
    assert catalog.features(spark, sf_dir).count() > 0
