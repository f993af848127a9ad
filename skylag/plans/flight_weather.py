"""Flights with the weather at both of their airports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import window_end, window_start
from ..functions.geo import LOWER_48, Box
from ..operators.clean import MEASURES, require_columns
from ..operators.nearest import nearest_join
from ..operators.windows import label_window_means, requested_windows
from ..sources.tables import broadcast_if_small, materialize

ROLES = {"origin": "dep", "dest": "arr"}

# As many stations may stand in a plan.
LISTED = 1000

_AIRPORT, _STATION = ("airport_id", "lat", "lon"), ("station_id", "lat", "lon")


def nearest_stations(
    airports: DataFrame,
    stations: DataFrame,
    box: Box = LOWER_48,
    airport_cols: Sequence[str] = ("airport_id", "lat", "lon"),
    station_cols: Sequence[str] = ("station_id", "lat", "lon"),
) -> DataFrame:
    """The nearest station of each airport, as a written table: three joins read it.

    ``airport_cols`` and ``station_cols`` name the key, latitude and longitude.
    """
    require_columns(airports, airport_cols)
    require_columns(stations, station_cols)
    airports = airports.select(*[F.col(c).alias(n) for c, n in zip(airport_cols, _AIRPORT, strict=True)])
    stations = stations.select(*[F.col(c).alias(n) for c, n in zip(station_cols, _STATION, strict=True)])
    return materialize(nearest_join(airports, stations, box), "nearest")


def with_window_bounds(flights: DataFrame, window_hours: int = 10) -> DataFrame:
    """Begin and end of the weather window at both airports.

    Both hang on the flight's date, also when it lands on the next day, and
    local times are taken as they are.
    """
    day = F.col("fl_date")
    return flights.withColumns(
        {
            f"{role}_weather_{edge}": bound
            for role, side in ROLES.items()
            for edge, bound in (
                ("start", window_start(day, F.col(f"{side}_time_blk"), window_hours)),
                ("end", window_end(day, F.col(f"{side}_time_blk"))),
            )
        }
    )


def with_stations(flights: DataFrame, nearest: DataFrame) -> DataFrame:
    """Add station and position of both airports; a flight needs both.

    The lookup is broadcast if a count shows that it is small, and joined by
    shuffle otherwise, where adaptive execution splits hot airports.
    """
    lookup = broadcast_if_small(
        nearest.select("airport_id", "station_id", "airport_lat", "airport_lon")
    )
    names = list(flights.columns)
    for role in ROLES:
        airport = lookup.select(
            F.col("airport_id").alias(role),
            F.col("station_id").alias(f"{role}_station_id"),
            F.col("airport_lat").alias(f"{role}_airport_lat"),
            F.col("airport_lon").alias(f"{role}_airport_lon"),
        )
        names += airport.columns[1:]
        flights = flights.join(airport, role)
    return flights.select(*names)


def windows_of(flights: DataFrame, nearest: DataFrame, window_hours: int = 10) -> DataFrame:
    """The weather windows that flights ask for, each station, day and label once, written.

    Flights of an airport, day and label count once before they meet the stations, so a hot
    airport shrinks before any shuffle.
    """
    sides = [
        F.struct(
            F.col(role).alias("airport_id"),
            F.col("fl_date").alias("day"),
            F.col(f"{side}_time_blk").alias("label"),
        )
        for role, side in ROLES.items()
    ]
    asked = flights.select(F.inline(F.array(*sides))).distinct()
    stations = broadcast_if_small(nearest.select("airport_id", F.col("station_id").alias("station")))
    return materialize(
        requested_windows(asked.join(stations, "airport_id"), window_hours), "windows"
    )


def near_in_time(weather: DataFrame, windows: DataFrame) -> DataFrame:
    """Observations between the first begin and the last end of some windows.

    One small aggregate; the bounds are literals and reach the scan.
    """
    first, last = windows.agg(F.min("start"), F.max("end")).first()
    if first is None:
        return weather.filter(F.lit(False))
    kind = weather.schema["date"].dataType
    low, high = (F.lit(edge.isoformat(" ")).cast(kind) for edge in (first, last))
    return weather.filter((F.col("date") >= low) & (F.col("date") <= high))


def at_stations(weather: DataFrame, nearest: DataFrame) -> DataFrame:
    """Observations of the stations that some airport has.

    Up to ``LISTED`` stations are literals and reach the scan, before anything is unpacked;
    more are joined.
    """
    used = nearest.select(F.col("station_id").alias("station"))
    found = used.filter("station IS NOT NULL").distinct().limit(LISTED + 1).collect()
    if len(found) <= LISTED:
        return weather.filter(F.col("station").isin([row[0] for row in found]))
    return weather.join(broadcast_if_small(used), "station", "left_semi")


def interval_join(
    flights: DataFrame,
    weather: DataFrame,
    role: str,
    window_hours: int = 10,
    columns: Sequence[str] = ("flight_id",),
) -> DataFrame:
    """Each flight with each observation of its window at one of its airports.

    ``flights`` holds ``<role>_station_id`` beside what the windows need. A flight
    without observations stays once, with NULL ``station`` and ``date``, and so does one without
    a window. Windows are cut into hours, so that the join is one of equal stations and hours,
    with the exact bounds tested after it: an observation meets only flights whose window
    touches its hour. It is a left join: each hour without observations keeps a row, and of
    these rows only that of the first hour stays, and only where the flight's other hours
    have no observation either.

    Flights alike in ``columns``, station and window stand for themselves: each gives its own
    rows, and all have the same. ``columns`` need not be a key.
    """
    windows = with_window_bounds(flights, window_hours).select(
        *columns,
        F.col(f"{role}_station_id").alias("_station"),
        F.col(f"{role}_weather_start").alias("_start"),
        F.col(f"{role}_weather_end").alias("_end"),
    )
    first, last = F.date_trunc("hour", "_start"), F.date_trunc("hour", "_end")
    # An empty window keeps its first hour, and one that is NULL a NULL hour, which meet nothing.
    touched = F.when(F.col("_start") <= F.col("_end"), F.sequence(first, last, F.expr("INTERVAL 1 HOUR")))
    hours = windows.withColumn("_hour", F.explode(F.coalesce(touched, F.array(first))))
    seen = weather.select("station", "date", F.date_trunc("hour", "date").alias("_seen"))
    met = hours.join(
        seen,
        (F.col("_station") == F.col("station"))
        & (F.col("_hour") == F.col("_seen"))
        & F.col("date").between(F.col("_start"), F.col("_end")),
        "left",
    )
    flight = Window.partitionBy(*columns, "_station", "_start", "_end")
    kept = F.col("station").isNotNull() | (
        (F.col("_matches") == 0) & F.col("_hour").eqNullSafe(F.date_trunc("hour", "_start"))
    )
    return (
        met.withColumn("_matches", F.count("station").over(flight))
        .filter(kept)
        .select(*columns, "station", "date")
    )


def flight_weather(
    flights: DataFrame,
    nearest: DataFrame,
    weather: DataFrame,
    window_hours: int = 10,
    measures: Sequence[str] = MEASURES,
    counts: bool = False,
    windows: DataFrame | None = None,
) -> DataFrame:
    """Cleaned flights with mean measures ``dep_*`` and ``arr_*`` of their windows.

    Time blocks may have any label of the form ``hhmm-hhmm``. A flight without observations
    keeps NULL means, and so does one whose label is none. ``counts`` adds how many
    observations each window held.

    The windows asked for and their means are written and read back. Both joins then read the
    finished table: broadcast where its size allows, else shuffled with nothing between
    shuffle and join, so that adaptive execution can split the flights of a hot
    station and block. ``windows`` are those of ``windows_of`` where the caller has them.
    """
    if windows is None:
        windows = windows_of(flights, nearest, window_hours)
    seen = at_stations(near_in_time(weather, windows), nearest)
    means = materialize(label_window_means(seen, windows, measures), "window-means")
    merged = with_stations(flights, nearest)
    names = list(merged.columns)
    for role, side in ROLES.items():
        columns = [F.col(name).alias(f"{side}_{name}") for name in measures]
        if counts:
            columns.append(F.col("n_obs").alias(f"{side}_n_obs"))
        window = means.select(
            F.col("station").alias(f"{role}_station_id"),
            F.col("day").alias("fl_date"),
            F.col("label").alias(f"{side}_time_blk"),
            *columns,
        )
        merged = merged.join(
            window, [f"{role}_station_id", "fl_date", f"{side}_time_blk"], "left"
        )
        names += window.columns[3:]
    return merged.select(*names)
