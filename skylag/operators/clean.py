"""Cleaning of flight records and weather observations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import (
    flag,
    is_arrival_rush,
    is_departure_rush,
    is_late,
    is_rush_month,
    packed_number,
)
from ..functions.geo import US_BOXES, Box, in_any_box

# The reasons a delay can have.
DELAY_CAUSES = [
    "carrier_delay",
    "weather_delay",
    "nas_delay",
    "security_delay",
    "late_aircraft_delay",
]

# The flight columns that later steps may use.
FLIGHT_COLUMNS = [
    "year",
    "month",
    "is_rush_month",
    "day_of_week",
    "fl_date",
    "op_unique_carrier",
    "origin",
    "dest",
    "crs_dep_time",
    "dep_time",
    "is_dep_rush_hour",
    "dep_delay",
    "dep_time_blk",
    "dep_del15",
    "crs_arr_time",
    "arr_time",
    "is_arr_rush_hour",
    "arr_delay",
    "arr_time_blk",
    "arr_del15",
    "crs_elapsed_time",
    "distance",
    *DELAY_CAUSES,
]

# Measure, packed field, position in it, codes for a missing value.
WEATHER_MEASURES = [
    ("wnd_angle", "wnd", 0, (999,)),
    ("wnd_speed", "wnd", 3, (9999,)),
    ("cig_height", "cig", 0, (99999,)),
    ("vis_dist", "vis", 0, (99999, 999999)),
    ("tmp_f", "tmp", 0, (9999,)),
    ("dew_0", "dew", 0, (9999,)),
    ("slp_0", "slp", 0, (99999,)),
]

MEASURES = [name for name, _, _, _ in WEATHER_MEASURES]


def flown(flights: DataFrame) -> DataFrame:
    """Flights that took place: neither cancelled nor diverted, both known."""
    return flights.filter(~F.col("cancelled") & ~F.col("diverted"))


def cause_flags(causes: Sequence[str] = DELAY_CAUSES) -> dict[str, Column]:
    """1 where a cause was recorded, 0 where it was not."""
    return {cause: F.col(cause).isNotNull().cast("int") for cause in causes}


def rush_flags(departure: str = "dep_time", arrival: str = "arr_time") -> dict[str, Column]:
    """Rush-month and rush-hour flags. The actual times are the default; pass the
    scheduled ones to keep facts of the day itself out of a model."""
    return {
        "is_rush_month": is_rush_month(F.col("month")),
        "is_dep_rush_hour": is_departure_rush(F.col(departure)),
        "is_arr_rush_hour": is_arrival_rush(F.col(arrival)),
    }


def delay_flags(late_after: float = 15) -> dict[str, Column]:
    return {
        "dep_del15": is_late(F.col("dep_delay"), late_after),
        "arr_del15": is_late(F.col("arr_delay"), late_after),
    }


def require_columns(df: DataFrame, wanted: Sequence[str]) -> None:
    """Fail if a column is absent; names count in any case."""
    present = {name.lower() for name in df.columns}
    absent = [name for name in wanted if name.lower() not in present]
    if absent:
        raise ValueError(f"columns {absent} are not among {df.columns}")


def keep_columns(df: DataFrame, wanted: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """The wanted columns in the wanted order; only optional ones may be absent."""
    present = {name.lower() for name in df.columns}
    kept = [n for n in wanted if n.lower() in present or n not in optional]
    require_columns(df, kept)
    return df.select(*kept)


def clean_flights(
    flights: DataFrame,
    late_after: float = 15,
    key: Sequence[str] = ("flight_id",),
    departure: str = "dep_time",
    arrival: str = "arr_time",
) -> DataFrame:
    """Drop flights that did not take place, derive the flags, fill unknown delays
    with 0 before they are compared, and keep the columns of later use.

    One narrow pass: filters and column choice reach the scan, nothing shuffles.
    ``key`` names the columns that tell flights apart; an absent column is an error.
    """
    filled = flown(flights).fillna(0, subset=["arr_delay", "dep_delay"])
    derived = filled.withColumns(
        {**cause_flags(), **rush_flags(departure, arrival), **delay_flags(late_after)}
    )
    return keep_columns(derived, [*key, *FLIGHT_COLUMNS])


def us_weather(weather: DataFrame, boxes: list[Box] = US_BOXES) -> DataFrame:
    """Observations inside one of the boxes, in a single scan."""
    return weather.filter(in_any_box(F.col("latitude"), F.col("longitude"), boxes))


def us_weather_by_union(weather: DataFrame, boxes: list[Box] = US_BOXES) -> DataFrame:
    """The same rows as a UNION ALL of one filter per box, for boxes that are
    disjoint. It scans once per box; ``us_weather`` is the form to use."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return reduce(DataFrame.unionByName, [weather.filter(box.holds(lat, lon)) for box in boxes])


def parse_weather(weather: DataFrame) -> DataFrame:
    """Unpack the measures from their comma-packed fields."""
    return weather.select(
        "station",
        "date",
        "elevation",
        "latitude",
        "longitude",
        *[
            packed_number(F.col(field), position).alias(name)
            for name, field, position, _ in WEATHER_MEASURES
        ],
    )


def drop_missing_measures(parsed: DataFrame) -> DataFrame:
    """Rows in which every measure is there and none is a code for "missing"."""
    tests = [~F.col(name).isin(*codes) for name, _, _, codes in WEATHER_MEASURES]
    return parsed.filter(reduce(Column.__and__, tests))


def clean_weather(weather: DataFrame, boxes: list[Box] = US_BOXES) -> DataFrame:
    """US observations with parsed, complete measures and their day and hour."""
    complete = drop_missing_measures(parse_weather(us_weather(weather, boxes)))
    return complete.withColumns(
        {"date_part": F.to_date("date"), "hour_part": F.hour("date")}
    )


def arrival_status(flights: DataFrame, late_after: float = 15) -> DataFrame:
    """Add ``arrival_status``: late, cancelled and diverted flights are 'delayed'."""
    trouble = (F.col("arr_delay") > late_after) | F.col("cancelled") | F.col("diverted")
    label = F.when(flag(trouble) == 1, "delayed").otherwise("on time")
    return flights.withColumn("arrival_status", label)
