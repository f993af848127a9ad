"""Every operator as a named query over a folder of star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.blocks import block_code
from ..functions.geo import LOWER_48, haversine_km
from ..operators import clean, encode, profile
from ..operators.metrics import confusion, metrics
from ..operators.nearest import nearest_join, pair_counts, points
from ..operators.quantiles import box_summary
from ..operators.row_ids import with_row_id
from ..operators.sampling import md5_draw, modular_draw, split_by_year, undersample
from ..session import scratch_path
from ..sources import derived
from ..sources.tables import (
    malformed_cells,
    materialize,
    read_csv,
    read_parquet,
    read_parquet_glob,
    write_parquet,
)
from . import models
from .flight_weather import (
    flight_weather,
    interval_join,
    nearest_stations,
    windows_of,
    with_stations,
    with_window_bounds,
)
from .training import LABEL, SCALED, Prepared, assembler, feature_columns, prepare, stored

Query = Callable[[SparkSession, str], DataFrame]

# Columns of the flight records that profiles run over.
PROFILED = [
    "year", "month", "day_of_week", "crs_dep_time", "dep_time", "dep_delay", "crs_arr_time",
    "arr_time", "arr_delay", *clean.DELAY_CAUSES, "crs_elapsed_time", "distance",
]

_MODEL_COLUMNS = ["flight_id", LABEL, *feature_columns(derived.CARRIERS)]

stored_merges: dict[tuple[str, str, tuple[str, ...]], DataFrame] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at six digits, so that results of different engines compare."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.select(
        *[F.round(name, digits).alias(name) if name in doubles else name for name in df.columns]
    )


def _text(*names: str) -> dict:
    return {name: F.col(name).cast("string") for name in names}


def _clean_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_flights(derived.flights(spark, sf_dir))


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_stations(derived.airports(spark, sf_dir), derived.stations(spark, sf_dir))


def _flight_weather(spark: SparkSession, sf_dir: str, counts: bool = False) -> DataFrame:
    flights, nearest = _clean_flights(spark, sf_dir), _nearest(spark, sf_dir)
    return flight_weather(
        derived.finished(flights, flights.columns),
        nearest,
        clean.clean_weather(derived.weather(spark, sf_dir)),
        counts=counts,
        # These read five columns; of finished flights all would be derived.
        windows=windows_of(flights, nearest),
    )


def merged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged table, written once per session and read by all later steps, as long
    as the tables it comes from have the same files."""
    sources = ("orders", "nation", "supplier", "region", "events")
    files = tuple(
        sorted(f for name in sources for f in read_parquet(spark, f"{sf_dir}/{name}.parquet").inputFiles())
    )
    key = (spark.sparkContext.applicationId, sf_dir, files)
    if key not in stored_merges:
        stored_merges[key] = materialize(_flight_weather(spark, sf_dir), "merged", ["year"])
    return stored_merges[key]


def _prepared(spark: SparkSession, sf_dir: str, draw=None) -> Prepared:
    return prepare(merged_table(spark, sf_dir), derived.TEST_YEAR, derived.CARRIERS, draw)


# Sources and sinks


def src_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "stations-csv")
    rows = derived.stations(spark, sf_dir).select(
        "lon", F.lit("x").alias("extra"), "station_id", "neighbor_id", "lat"
    )
    rows.write.option("header", True).csv(path)
    schema = "station_id bigint, lat double, lon double, neighbor_id int"
    return read_csv(spark, path, schema)


def src_csv_malformed(spark, sf_dir):
    """Cells of a file that are no numbers, some with line ends inside quotes."""
    path = scratch_path(spark, "stations-csv")
    rows = derived.stations(spark, sf_dir).selectExpr(
        "station_id",
        "CASE WHEN station_id % 7 = 0 THEN 'n/a' WHEN station_id % 7 = 1 THEN concat('4', chr(10), '0')"
        " ELSE '40.5' END AS lat",
        "CASE WHEN station_id % 5 = 0 THEN concat(station_id, ' west') ELSE '-100' END AS lon",
        "CASE WHEN station_id % 3 > 0 THEN neighbor_id END AS neighbor_id",
    )
    rows.write.option("header", True).csv(path)
    schema = "station_id bigint, lat double, lon double, neighbor_id int"
    return malformed_cells(spark, path, schema, multiline=True)


def src_parquet(spark, sf_dir):
    return read_parquet(spark, f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )


def _flights_by_year(spark, sf_dir):
    path = scratch_path(spark, "flights")
    write_parquet(_clean_flights(spark, sf_dir), path, ["year"])
    return path


def src_parquet_glob(spark, sf_dir):
    path = _flights_by_year(spark, sf_dir)
    rows = read_parquet_glob(spark, f"{path}/year=199*", base=path)
    return rows.select("flight_id", "year", "origin", "dest", "arr_delay")


def sink_parquet(spark, sf_dir):
    rows = read_parquet(spark, _flights_by_year(spark, sf_dir))
    return rows.withColumns(_text("fl_date"))


def schema_report(spark, sf_dir):
    return profile.schema_report(derived.flights(spark, sf_dir))


def preview_topn(spark, sf_dir):
    rows = derived.flights(spark, sf_dir).select(
        "flight_id", "fl_date", "op_unique_carrier", "origin", "dest", "distance"
    )
    return rows.orderBy(F.desc("distance"), "flight_id").limit(5).withColumns(_text("fl_date"))


def global_sort(spark, sf_dir):
    rows = derived.flights(spark, sf_dir).select("fl_date", "flight_id", "op_unique_carrier")
    return rows.orderBy("fl_date", "flight_id").withColumns(_text("fl_date"))


# Cleaning


def flights_clean(spark, sf_dir):
    return _clean_flights(spark, sf_dir).withColumns(_text("fl_date"))


def delay_cause_flags(spark, sf_dir):
    flags = clean.cause_flags()
    return derived.flights(spark, sf_dir).select(
        "flight_id", *[column.alias(name) for name, column in flags.items()]
    )


def delay_flags(spark, sf_dir):
    rows = derived.flights(spark, sf_dir).fillna(0, subset=["arr_delay", "dep_delay"])
    return rows.select(
        "flight_id", *[column.alias(name) for name, column in clean.delay_flags().items()]
    )


def rush_flags(spark, sf_dir):
    return derived.flights(spark, sf_dir).select(
        "flight_id", *[column.alias(name) for name, column in clean.rush_flags().items()]
    )


def weather_parsed(spark, sf_dir):
    rows = clean.parse_weather(derived.weather(spark, sf_dir))
    return rows.withColumns(_text("date"))


def weather_clean(spark, sf_dir):
    rows = clean.clean_weather(derived.weather(spark, sf_dir))
    return rows.withColumns(_text("date", "date_part"))


def _observation_keys(rows):
    return rows.select("event_id", "station", "latitude", "longitude")


def region_filter(spark, sf_dir):
    return _observation_keys(clean.us_weather(derived.weather(spark, sf_dir)))


def union_regions(spark, sf_dir):
    return _observation_keys(clean.us_weather_by_union(derived.weather(spark, sf_dir)))


def bbox_filter(spark, sf_dir):
    rows = derived.stations(spark, sf_dir)
    return rows.filter(LOWER_48.holds(F.col("lat"), F.col("lon")))


def year_split(spark, sf_dir):
    train, test = split_by_year(
        derived.flights(spark, sf_dir).select("flight_id", "year"), derived.TEST_YEAR
    )
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


# Joins


def distinct_points(spark, sf_dir):
    return points(derived.stations(spark, sf_dir), "station_id", "lat", "lon", LOWER_48)


def geo_pairs(spark, sf_dir):
    stations = derived.stations(spark, sf_dir).select("station_id", "lat", "lon")
    return pair_counts(derived.airports(spark, sf_dir), stations)


def nearest_station(spark, sf_dir):
    return rounded(nearest_join(derived.airports(spark, sf_dir), derived.stations(spark, sf_dir)))


def haversine(spark, sf_dir):
    rows = with_stations(
        derived.flights(spark, sf_dir).select("flight_id", "origin", "dest"),
        _nearest(spark, sf_dir),
    )
    route = haversine_km(
        *[F.col(f"{role}_airport_{axis}") for role in ("origin", "dest") for axis in ("lat", "lon")]
    )
    return rounded(rows.select("flight_id", route.alias("route_km")))


def flight_stations(spark, sf_dir):
    rows = with_stations(_clean_flights(spark, sf_dir), _nearest(spark, sf_dir))
    return rows.select(
        "flight_id",
        "origin",
        "dest",
        "origin_station_id",
        "origin_airport_lat",
        "origin_airport_lon",
        "dest_station_id",
        "dest_airport_lat",
        "dest_airport_lon",
    )


def window_bounds(spark, sf_dir):
    rows = with_window_bounds(derived.flights(spark, sf_dir))
    names = [f"{role}_weather_{edge}" for role in ("origin", "dest") for edge in ("start", "end")]
    return rows.select("flight_id", *names).withColumns(_text(*names))


def weather_window_join(spark, sf_dir):
    """Matches of each flight's two left joins, and the rows that both would give."""
    counted = _flight_weather(spark, sf_dir, counts=True).select(
        "flight_id",
        F.coalesce("dep_n_obs", F.lit(0)).alias("origin_matches"),
        F.coalesce("arr_n_obs", F.lit(0)).alias("dest_matches"),
    )
    lines = F.greatest("origin_matches", F.lit(1)) * F.greatest("dest_matches", F.lit(1))
    return counted.withColumn("joined_rows", lines)


def _interval_rows(role: str) -> Query:
    """Each flight with the observations of its window at one of its airports."""

    def query(spark, sf_dir):
        flights = with_stations(_clean_flights(spark, sf_dir), _nearest(spark, sf_dir))
        weather = clean.clean_weather(derived.weather(spark, sf_dir))
        return interval_join(flights, weather, role).withColumns(_text("station", "date"))

    return query


def flight_weather_any_label(spark, sf_dir):
    """The merge with time blocks that no list holds: from the minute of the event to the
    end of its hour."""
    flights = _clean_flights(spark, sf_dir)
    flights = derived.finished(flights, flights.columns)
    labels = {
        f"{side}_time_blk": F.format_string(
            "%04d-%02d59", f"{side}_time", F.expr(f"{side}_time DIV 100")
        )
        for side in ("dep", "arr")
    }
    merged = flight_weather(
        flights.withColumns(labels),
        _nearest(spark, sf_dir),
        clean.clean_weather(derived.weather(spark, sf_dir)),
        counts=True,
    )
    measured = [f"{side}_{name}" for side in ("dep", "arr") for name in ("n_obs", *clean.MEASURES)]
    merged = merged.fillna(0, subset=["dep_n_obs", "arr_n_obs"])
    return rounded(merged.select("flight_id", "dep_time_blk", "arr_time_blk", *measured))


def flight_weather_means(spark, sf_dir):
    return rounded(_flight_weather(spark, sf_dir)).withColumns(_text("fl_date"))


# Profiles


def arrival_status(spark, sf_dir):
    rows = clean.arrival_status(derived.flights(spark, sf_dir))
    return profile.status_counts(rows, "arrival_status")


def _late_counts(delay: str, period: str) -> Query:
    return lambda spark, sf_dir: profile.late_counts(derived.flights(spark, sf_dir), delay, period)


def _delay_histogram(delay: str) -> Query:
    def query(spark, sf_dir):
        rows = profile.ordinary_delays(derived.flights(spark, sf_dir), delay)
        return rounded(profile.histogram(rows, delay, 30))

    return query


def hist_all_numeric(spark, sf_dir):
    return rounded(profile.histograms(derived.flights(spark, sf_dir), PROFILED, 50))


def corr_matrix(spark, sf_dir):
    return rounded(profile.correlations(derived.flights(spark, sf_dir), PROFILED))


def describe_numeric(spark, sf_dir):
    return rounded(profile.describe_numeric(derived.flights(spark, sf_dir), PROFILED))


def describe_text(spark, sf_dir):
    return profile.describe_text(derived.flights(spark, sf_dir))


def delay_summary(spark, sf_dir):
    return rounded(profile.summary(derived.flights(spark, sf_dir), ["dep_delay", "arr_delay"]))


def carrier_share(spark, sf_dir):
    return rounded(profile.share(derived.flights(spark, sf_dir), "op_unique_carrier"))


def carrier_delay_mean(spark, sf_dir):
    return rounded(
        profile.mean_by(derived.flights(spark, sf_dir), "op_unique_carrier", "carrier_delay")
    )


def carrier_delay_box(spark, sf_dir):
    return rounded(
        box_summary(derived.flights(spark, sf_dir), "op_unique_carrier", "carrier_delay")
    )


def period_count_box(spark, sf_dir):
    """Box plots of the four tables of late counts, one box per month or block."""
    flights = derived.flights(spark, sf_dir)
    charts = [
        profile.late_counts(flights, f"{side}_delay", period).select(
            F.concat_ws(":", F.lit(side), F.col(period)).alias("box"), "delay_counts"
        )
        for side, periods in (("dep", ("month", "dep_time_blk")), ("arr", ("month", "arr_time_blk")))
        for period in periods
    ]
    return rounded(box_summary(reduce(DataFrame.unionByName, charts), "box", "delay_counts"))


def null_report(spark, sf_dir):
    return profile.null_report(merged_table(spark, sf_dir))


def distinct_categories(spark, sf_dir):
    return profile.distinct_values(derived.flights(spark, sf_dir), "op_unique_carrier")


# Encoding


def block_codes(spark, sf_dir):
    return derived.flights(spark, sf_dir).select(
        "flight_id",
        block_code(F.col("dep_time_blk")).alias("dep_time_blk"),
        block_code(F.col("arr_time_blk")).alias("arr_time_blk"),
    )


def lon_zone(spark, sf_dir):
    rows = with_stations(
        derived.flights(spark, sf_dir).select("flight_id", "origin", "dest"),
        _nearest(spark, sf_dir),
    )
    return rows.select(
        "flight_id", *[column.alias(name) for name, column in encode.zone_flags().items()]
    )


def carrier_dummies(spark, sf_dir):
    flights = derived.flights(spark, sf_dir)
    found = encode.categories(flights, "op_unique_carrier")
    columns = encode.dummies("op_unique_carrier", found)
    return flights.select("flight_id", *[c.alias(name) for name, c in columns.items()])


def category_positions(spark, sf_dir):
    """Positions of routes in sparse vectors, learned from all years but the last."""
    flights = derived.flights(spark, sf_dir).selectExpr(
        "flight_id", "year", "concat_ws('-', op_unique_carrier, origin, dest) AS route"
    )
    known = encode.category_dictionary(flights.filter(F.col("year") != derived.TEST_YEAR), "route")
    return encode.category_vectors(flights, "route", known, "vector", "position").select(
        "flight_id", "route", F.coalesce("position", F.lit(-1)).alias("position")
    )


def composite_id(spark, sf_dir):
    """Rows numbered by a key of several columns."""
    rows = derived.flights(spark, sf_dir).select(
        "fl_date", "op_unique_carrier", "origin", "flight_id"
    )
    numbered = with_row_id(rows, ["fl_date", "op_unique_carrier", "flight_id"])
    return numbered.withColumns(_text("fl_date"))


def surrogate_id(spark, sf_dir):
    rows = derived.flights(spark, sf_dir).select("flight_id", "op_unique_carrier")
    return with_row_id(rows, "flight_id")


# Sampling, scaling, features


def _training_rows(spark, sf_dir):
    train, _ = split_by_year(merged_table(spark, sf_dir), derived.TEST_YEAR)
    return train.select("flight_id", LABEL)


def undersample_hash(spark, sf_dir):
    return undersample(_training_rows(spark, sf_dir), LABEL, modular_draw(F.col("flight_id")))


def undersample_seeded(spark, sf_dir):
    draw = md5_draw(F.col("flight_id"))
    return undersample(_training_rows(spark, sf_dir), LABEL, draw)


def _modular(spark, sf_dir):
    return _prepared(spark, sf_dir, modular_draw(F.col("flight_id")))


def _scaled_columns(rows):
    return rounded(rows.select("flight_id", *[f"{name}_scaled" for name in SCALED]))


def minmax_train(spark, sf_dir):
    return _scaled_columns(_modular(spark, sf_dir).train)


def minmax_test(spark, sf_dir):
    return _scaled_columns(_modular(spark, sf_dir).test)


def features(spark, sf_dir):
    """Every element of the feature vectors of the test rows, by its position."""
    test = _modular(spark, sf_dir).test.select(*_MODEL_COLUMNS)
    vectors = assembler(derived.CARRIERS).transform(materialize(test, "test"))
    return rounded(
        vectors.select(
            "flight_id",
            F.col(LABEL),
            F.posexplode(vector_to_array("features")).alias("position", "value"),
        )
    )


# Models


def _for_models(prepared: Prepared) -> Prepared:
    return stored(prepared, _MODEL_COLUMNS)


def _candidates() -> dict[str, models.Candidate]:
    return {candidate.name: candidate for candidate in models.all_candidates()}


def _model(name: str) -> Query:
    def query(spark, sf_dir):
        prepared = _for_models(_prepared(spark, sf_dir))
        scored = models.train_and_score(_candidates()[name], prepared, derived.CARRIERS)
        return scored.select("flight_id", F.col(LABEL).cast("double").alias("label"), "prediction")

    return query


def _grid_scores(name: str) -> Query:
    def query(spark, sf_dir):
        train = _for_models(_prepared(spark, sf_dir)).train
        predictions = models.grid_predictions(_candidates()[name], train, derived.CARRIERS)
        return rounded(models.grid_scores(predictions))

    return query


def leaderboard(spark, sf_dir):
    prepared = _for_models(_prepared(spark, sf_dir))
    candidates = models.all_candidates()
    return rounded(models.leaderboard(candidates, prepared, derived.CARRIERS))


def _rule(spark, sf_dir):
    """A fixed rule as prediction: who leaves late arrives late."""
    return _clean_flights(spark, sf_dir).select(LABEL, F.col("dep_del15").alias("prediction"))


def confusion_matrix(spark, sf_dir):
    return confusion(_rule(spark, sf_dir), LABEL)


def rule_metrics(spark, sf_dir):
    return rounded(metrics(confusion(_rule(spark, sf_dir), LABEL)))


QUERIES: dict[str, Query] = {
    "src_csv_roundtrip": src_csv_roundtrip,
    "src_csv_malformed": src_csv_malformed,
    "src_parquet": src_parquet,
    "src_parquet_glob": src_parquet_glob,
    "sink_parquet": sink_parquet,
    "schema_report": schema_report,
    "preview_topn": preview_topn,
    "global_sort": global_sort,
    "flights_clean": flights_clean,
    "delay_cause_flags": delay_cause_flags,
    "delay_flags": delay_flags,
    "rush_flags": rush_flags,
    "weather_parsed": weather_parsed,
    "weather_clean": weather_clean,
    "region_filter": region_filter,
    "union_regions": union_regions,
    "bbox_filter": bbox_filter,
    "year_split": year_split,
    "distinct_points": distinct_points,
    "geo_pairs": geo_pairs,
    "nearest_station": nearest_station,
    "haversine": haversine,
    "flight_stations": flight_stations,
    "window_bounds": window_bounds,
    "weather_window_join": weather_window_join,
    "interval_rows": _interval_rows("origin"),
    "interval_rows_dest": _interval_rows("dest"),
    "flight_weather": flight_weather_means,
    "flight_weather_any_label": flight_weather_any_label,
    "arrival_status": arrival_status,
    "dep_delay_by_month": _late_counts("dep_delay", "month"),
    "arr_delay_by_month": _late_counts("arr_delay", "month"),
    "dep_delay_by_block": _late_counts("dep_delay", "dep_time_blk"),
    "arr_delay_by_block": _late_counts("arr_delay", "arr_time_blk"),
    "hist_dep": _delay_histogram("dep_delay"),
    "hist_arr": _delay_histogram("arr_delay"),
    "hist_all_numeric": hist_all_numeric,
    "corr_matrix": corr_matrix,
    "describe_numeric": describe_numeric,
    "describe_text": describe_text,
    "delay_summary": delay_summary,
    "carrier_share": carrier_share,
    "carrier_delay_mean": carrier_delay_mean,
    "carrier_delay_box": carrier_delay_box,
    "period_count_box": period_count_box,
    "null_report": null_report,
    "distinct_categories": distinct_categories,
    "block_code": block_codes,
    "lon_zone": lon_zone,
    "carrier_dummies": carrier_dummies,
    "category_positions": category_positions,
    "surrogate_id": surrogate_id,
    "composite_id": composite_id,
    "undersample_hash": undersample_hash,
    "undersample": undersample_seeded,
    "minmax_train": minmax_train,
    "minmax_test": minmax_test,
    "features": features,
    "lr_base": _model("lr_base"),
    "lr_enet_cv": _model("lr_enet_cv"),
    "dt_cv": _model("dt_cv"),
    "rf_cv": _model("rf_cv"),
    "gbt_cv": _model("gbt_cv"),
    "lr_enet_grid": _grid_scores("lr_enet_cv"),
    "dt_grid": _grid_scores("dt_cv"),
    "leaderboard": leaderboard,
    "confusion": confusion_matrix,
    "metrics": rule_metrics,
}
