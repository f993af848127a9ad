"""The queries in plain SQL: joins written out, no pre-aggregation, no grid.

Each text is a chain of named tables followed by one SELECT.
"""

from __future__ import annotations

from skylag.functions.blocks import TIME_BLOCKS
from skylag.functions.geo import US_BOXES
from skylag.operators.clean import DELAY_CAUSES, FLIGHT_COLUMNS, MEASURES, WEATHER_MEASURES
from skylag.plans.catalog import PROFILED
from skylag.plans.training import SCALED, WEATHER_MEANS, feature_columns
from skylag.sources.derived import AIRPORTS_SQL, CARRIERS, FLIGHTS_SQL, WEATHER_SQL

STATIONS_SQL = """
SELECT s_suppkey AS station_id, 20 + ((s_suppkey*37) % 350)/1e1 AS lat,
  -130 + ((s_suppkey*53) % 720)/1e1 AS lon, r_regionkey AS neighbor_id
FROM supplier CROSS JOIN region
"""

BOX = "{0} > 24.45 AND {0} < 49.46 AND {1} > -127.23 AND {1} < -60.04"


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371 * asin(sqrt(least(1.0, power(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def yes(test: str, name: str) -> str:
    return f"CAST(CASE WHEN {test} THEN 1 ELSE 0 END AS INTEGER) AS {name}"


def listed(items: list[str]) -> str:
    return ",\n  ".join(items)


CAUSES = [yes(f"{cause} IS NOT NULL", cause) for cause in DELAY_CAUSES]
RUSH = [
    yes("month IN (6, 7, 8)", "is_rush_month"),
    yes("dep_time BETWEEN 1500 AND 2000", "is_dep_rush_hour"),
    yes("arr_time BETWEEN 1600 AND 2200", "is_arr_rush_hour"),
]
LATE = [
    yes("coalesce(dep_delay, 0) > 15", "dep_del15"),
    yes("coalesce(arr_delay, 0) > 15", "arr_del15"),
]
REGION = " OR ".join(
    f"(latitude > {b.south} AND latitude < {b.north} AND longitude > {b.west} AND longitude < {b.east})"
    for b in US_BOXES
)
PARSED = [
    f"TRY_CAST(string_split({field}, ',')[{position + 1}] AS DOUBLE) AS {name}"
    for name, field, position, _ in WEATHER_MEASURES
]
COMPLETE = " AND ".join(
    f"{name} <> {code}" for name, _, _, codes in WEATHER_MEASURES for code in codes
)


def block_number(column: str) -> str:
    cases = " ".join(f"WHEN '{block}' THEN {i}" for i, block in enumerate(TIME_BLOCKS))
    return f"CAST(CASE {column} {cases} END AS INTEGER)"


def window_edge(column: str, at: int, hours: int) -> str:
    minutes = f"CAST(substr({column}, {at}, 2) AS INTEGER) * 60 + CAST(substr({column}, {at + 2}, 2) AS INTEGER)"
    return f"CAST(fl_date AS TIMESTAMP) + to_minutes({minutes} - {60 * hours})"


def edges(side: str) -> str:
    column = f"{side}_time_blk"
    role = {"dep": "origin", "arr": "dest"}[side]
    return (
        f"{window_edge(column, 1, 10)} AS {role}_weather_start, "
        f"{window_edge(column, 6, 1)} AS {role}_weather_end"
    )


TABLES = {
    "flights": f"""
SELECT * EXCLUDE (carrier, fl_day, dep_hour, arr_hour), carrier AS op_unique_carrier,
  CAST(DATE '2024-01-01' + fl_day AS DATE) AS fl_date, dep_hour * 100 AS crs_dep_time, arr_hour * 100 AS crs_arr_time
FROM ({FLIGHTS_SQL.format(orders="orders")}) f""",
    "airports": AIRPORTS_SQL.format(nation="nation"),
    "stations": STATIONS_SQL,
    "weather": WEATHER_SQL.format(events="events"),
    "flown": f"""
SELECT flight_id, {listed([c for c in FLIGHT_COLUMNS if c not in DELAY_CAUSES])},
  {listed(DELAY_CAUSES)}
FROM (SELECT flight_id, year, month, day_of_week, fl_date, op_unique_carrier, origin, dest,
  crs_dep_time, dep_time, coalesce(dep_delay, 0) AS dep_delay, dep_time_blk,
  crs_arr_time, arr_time, coalesce(arr_delay, 0) AS arr_delay, arr_time_blk, crs_elapsed_time, distance,
  {listed(CAUSES + RUSH + LATE)}
  FROM flights WHERE NOT cancelled AND NOT diverted) c""",
    "us_weather": f"SELECT * FROM weather WHERE {REGION}",
    "observed": f"""
SELECT * FROM (SELECT station, date, elevation, latitude, longitude, {listed(PARSED)} FROM us_weather) p
WHERE {COMPLETE}""",
    "spots": f"""
SELECT DISTINCT station_id, lat, lon FROM stations WHERE {BOX.format("lat", "lon")}""",
    "ports": f"SELECT DISTINCT airport_id, lat, lon FROM airports WHERE {BOX.format('lat', 'lon')}",
    "nearest": f"""
SELECT airport_id, station_id, haversine, airport_lat, airport_lon
FROM (SELECT *, row_number() OVER (PARTITION BY airport_id ORDER BY round(haversine, 6), station_id) AS row_num
  FROM (SELECT airport_id, station_id, p.lat AS airport_lat, p.lon AS airport_lon,
    {km("s.lat", "s.lon", "p.lat", "p.lon")} AS haversine FROM spots s CROSS JOIN ports p) d) r
WHERE row_num = 1""",
    "placed": """
SELECT f.*, o.station_id AS origin_station_id, o.airport_lat AS origin_airport_lat, o.airport_lon AS origin_airport_lon,
  d.station_id AS dest_station_id, d.airport_lat AS dest_airport_lat, d.airport_lon AS dest_airport_lon
FROM flown f JOIN nearest o ON f.origin = o.airport_id JOIN nearest d ON f.dest = d.airport_id""",
    "bounded": f"SELECT *, {edges('dep')}, {edges('arr')} FROM placed",
}
for _side, _role in (("dep", "origin"), ("arr", "dest")):
    TABLES[f"{_side}_means"] = f"""
SELECT flight_id, count(station) AS {_side}_n, {listed([f"avg({m}) AS {_side}_{m}" for m in MEASURES])}
FROM bounded LEFT JOIN observed ON {_role}_station_id = station
  AND {_role}_weather_start <= date AND {_role}_weather_end >= date
GROUP BY flight_id"""
TABLES["merged"] = """
SELECT placed.*, dep_means.* EXCLUDE (flight_id, dep_n), arr_means.* EXCLUDE (flight_id, arr_n)
FROM placed JOIN dep_means ON placed.flight_id = dep_means.flight_id
  JOIN arr_means ON placed.flight_id = arr_means.flight_id"""


def zones(role: str) -> list[str]:
    lon = f"{role}_airport_lon"
    return [
        yes(f"{lon} < -110", f"west_{role}"),
        yes(f"{lon} > -110 AND {lon} < -90", f"mid_{role}"),
        yes(f"{lon} > -90", f"east_{role}"),
    ]


DUMMIES = [yes(f"op_unique_carrier = '{c}'", c) for c in CARRIERS]

TABLES["encoded"] = f"""
SELECT * EXCLUDE (dep_time_blk, arr_time_blk), {block_number("dep_time_blk")} AS dep_time_blk,
  {block_number("arr_time_blk")} AS arr_time_blk, {listed(zones("origin") + zones("dest") + DUMMIES)}
FROM merged"""
TABLES["share"] = """
SELECT least(1.0, coalesce(CAST(count(*) FILTER (WHERE arr_del15 = 1) AS DOUBLE)
  / nullif(count(*) FILTER (WHERE arr_del15 <> 1), 0), 1.0)) AS share
FROM merged WHERE year <> 2001"""
# Unknown weather means are filled with those of all training rows, and flagged by side.
UNKNOWN = {
    f"{side}_weather_unknown": " OR ".join(f"{side}_{m} IS NULL" for m in MEASURES)
    for side in ("dep", "arr")
}
TABLES["typical"] = f"""
SELECT {listed([f"avg({c}) AS typical_{c}" for c in WEATHER_MEANS])} FROM encoded WHERE year <> 2001"""
TABLES["known"] = f"""
SELECT encoded.* REPLACE ({listed([f"coalesce({c}, typical_{c}, 0) AS {c}" for c in WEATHER_MEANS])}),
  {listed([yes(test, flag) for flag, test in UNKNOWN.items()])}
FROM encoded, typical"""
TABLES["train"] = """
SELECT known.* FROM known, share WHERE year <> 2001 AND (arr_del15 = 1 OR
  CAST(flight_id % 1000003 * 736877 % 1000003 AS DOUBLE) / CAST(1000003 AS DOUBLE) < share)"""
TABLES["test"] = "SELECT * FROM known WHERE year = 2001"
TABLES["ranges"] = f"""
SELECT {listed([f"CAST(min({c}) AS DOUBLE) AS low_{c}, CAST(max({c}) AS DOUBLE) AS high_{c}" for c in SCALED])}
FROM train"""


for _role in ("origin", "dest"):
    TABLES[f"observed_at_{_role}"] = f"""
SELECT flight_id, station, date FROM bounded LEFT JOIN observed ON {_role}_station_id = station
  AND {_role}_weather_start <= date AND {_role}_weather_end >= date"""


def any_label() -> str:
    """The merge with blocks from the minute of the event to the end of its hour."""

    def label(side: str) -> str:
        return f"concat(lpad(CAST({side}_time AS VARCHAR), 4, '0'), '-', lpad(CAST({side}_time // 100 AS VARCHAR), 2, '0'), '59')"

    def means(side: str, role: str) -> str:
        return f"""
SELECT flight_id, count(station) AS {side}_n_obs, {listed([r6(f"avg({m})", f"{side}_{m}") for m in MEASURES])}
FROM windowed LEFT JOIN observed ON {role}_station_id = station
  AND {role}_weather_start <= date AND {role}_weather_end >= date
GROUP BY flight_id"""

    return f"""{chain("placed")},
relabelled AS (SELECT * REPLACE ({label("dep")} AS dep_time_blk, {label("arr")} AS arr_time_blk) FROM placed),
windowed AS (SELECT *, {edges("dep")}, {edges("arr")} FROM relabelled),
departing AS ({means("dep", "origin")}),
arriving AS ({means("arr", "dest")})
SELECT * FROM (SELECT flight_id, dep_time_blk, arr_time_blk FROM relabelled)
  JOIN departing USING (flight_id) JOIN arriving USING (flight_id)"""
SCALED_NAMES = {f"{c}_scaled": c for c in SCALED}
FEATURE_COLUMNS = feature_columns(CARRIERS)


def scaled(column: str) -> str:
    return (
        f"CASE WHEN low_{column} = high_{column} AND {column} IS NOT NULL THEN CAST(0.5 AS DOUBLE)"
        f" ELSE ({column} - low_{column}) / (high_{column} - low_{column}) END"
    )


def chain(last: str) -> str:
    """WITH clause with the tables up to and including ``last``."""
    names = list(TABLES)
    return "WITH " + ",\n".join(
        f"{name} AS ({TABLES[name]})" for name in names[: names.index(last) + 1]
    )


def query(last: str, select: str) -> str:
    return f"{chain(last)}\n{select}"


def r6(expression: str, name: str) -> str:
    return f"round({expression}, 6) AS {name}"


def late_counts(delay: str, period: str) -> str:
    return (
        f"SELECT {period}, count({delay}) AS delay_counts FROM flights"
        f" WHERE {delay} > 15 GROUP BY {period}"
    )


def histogram(delay: str) -> str:
    return query(
        "flights",
        f"""
SELECT CAST(b.bin AS INTEGER) AS bin, {r6("low + b.bin * width", "bin_low")},
  round(CASE WHEN b.bin = 29 THEN high ELSE low + (b.bin + 1) * width END, 6) AS bin_high,
  count(v.value) AS n
FROM range(30) b(bin) CROSS JOIN (
  SELECT CAST(min({delay}) AS DOUBLE) AS low, CAST(max({delay}) AS DOUBLE) AS high,
    (CAST(max({delay}) AS DOUBLE) - min({delay})) / 30 AS width
  FROM flights WHERE NOT cancelled AND NOT diverted AND {delay} > 0 AND {delay} < 120) e
LEFT JOIN (SELECT CAST({delay} AS DOUBLE) AS value FROM flights
  WHERE NOT cancelled AND NOT diverted AND {delay} > 0 AND {delay} < 120) v
  ON least(floor((v.value - low) / width), 29) = b.bin
GROUP BY b.bin, low, high, width""",
    )


def per_column(select: str, columns: list[str], source: str = "flights") -> str:
    """One SELECT per column, put together; ``{c}`` stands for the column."""
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {select.replace('{c}', c)} FROM {source}" for c in columns
    )


def hist_all() -> str:
    long = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM flights WHERE {c} IS NOT NULL"
        for c in PROFILED
    )
    return f"""{chain("flights")},
long AS ({long}),
extents AS (SELECT column_name, CASE WHEN min(value) = max(value) THEN min(value) - CAST(0.5 AS DOUBLE) ELSE min(value) END AS low,
  CASE WHEN min(value) = max(value) THEN max(value) + CAST(0.5 AS DOUBLE) ELSE max(value) END AS high FROM long GROUP BY column_name),
edges AS (SELECT column_name, bin, low + bin * ((high - low) / 50) AS bin_low,
  CASE WHEN bin = 49 THEN high ELSE low + (bin + 1) * ((high - low) / 50) END AS bin_high
  FROM extents CROSS JOIN range(50) r(bin))
SELECT column_name, CAST(bin AS INTEGER) AS bin, round(bin_low, 6) AS bin_low, round(bin_high, 6) AS bin_high, count(value) AS n
FROM edges LEFT JOIN (SELECT column_name AS name, value FROM long) l
  ON name = column_name AND value >= bin_low AND (value < bin_high OR (bin = 49 AND value <= bin_high))
GROUP BY column_name, bin, bin_low, bin_high"""


def correlation() -> str:
    pairs = "\nUNION ALL\n".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) + CAST(0 AS DOUBLE) AS r FROM flights"
        for a in PROFILED
        for b in PROFILED
    )
    return query("flights", pairs)


def box(source: str, group: str, value: str) -> str:
    return f"""
SELECT {group}, max(n) AS n, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
  min(v) FILTER (WHERE inside) AS whisker_low, max(v) FILTER (WHERE inside) AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS outliers
FROM (SELECT *, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM (SELECT {group}, CAST({value} AS DOUBLE) AS v FROM {source} WHERE {value} IS NOT NULL) a
  JOIN (SELECT {group} AS g, count(*) AS n, quantile_cont(CAST({value} AS DOUBLE), 0.25) AS q1,
    quantile_cont(CAST({value} AS DOUBLE), 0.5) AS median, quantile_cont(CAST({value} AS DOUBLE), 0.75) AS q3
    FROM {source} WHERE {value} IS NOT NULL GROUP BY {group}) b ON a.{group} = b.g) c
GROUP BY {group}"""


def period_boxes() -> str:
    charts = [("dep", "month"), ("dep", "dep_time_blk"), ("arr", "month"), ("arr", "arr_time_blk")]
    counts = "\nUNION ALL\n".join(
        f"SELECT concat('{side}:', {period}) AS box, count(*) AS delay_counts FROM flights"
        f" WHERE {side}_delay > 15 GROUP BY {period}"
        for side, period in charts
    )
    return f"{chain('flights')}, counts AS ({counts})\n{box('counts', 'box', 'delay_counts')}"


# Types as Spark names them, for the schema report.
FLIGHT_TYPES = {
    "flight_id": "bigint", "year": "int", "month": "int", "day_of_week": "int",
    "op_unique_carrier": "string", "origin": "bigint", "dest": "bigint",
    "dep_time": "bigint", "arr_time": "bigint", "dep_time_blk": "string", "arr_time_blk": "string",
    "dep_delay": "bigint", "arr_delay": "bigint", **{cause: "bigint" for cause in DELAY_CAUSES},
    "cancelled": "boolean", "diverted": "boolean", "crs_elapsed_time": "bigint", "distance": "bigint",
    "fl_date": "date", "crs_dep_time": "int", "crs_arr_time": "int",
}

MERGED_COLUMNS = [
    "flight_id", *FLIGHT_COLUMNS,
    "origin_station_id", "origin_airport_lat", "origin_airport_lon",
    "dest_station_id", "dest_airport_lat", "dest_airport_lon", *WEATHER_MEANS,
]

CLEAN_SELECT = "SELECT * REPLACE (CAST(fl_date AS VARCHAR) AS fl_date) FROM flown"

def stamp(column: str) -> str:
    """A timestamp as Spark prints it: no trailing zeros in the fraction."""
    return f"CAST({column} AS VARCHAR)"


OBSERVATION_KEYS = "SELECT event_id, station, latitude, longitude FROM us_weather"

MATRIX = """
SELECT CAST(arr_del15 AS DOUBLE) AS label, CAST(dep_del15 AS DOUBLE) AS prediction, count(*) AS n
FROM flown GROUP BY arr_del15, dep_del15"""

ORACLE: dict[str, str] = {
    "src_csv_roundtrip": STATIONS_SQL,
    "src_csv_malformed": f"""
WITH cells AS (SELECT station_id % 7 AS seven, station_id % 5 AS five, station_id FROM ({STATIONS_SQL}) s)
SELECT 'lat' AS column_name, CASE seven WHEN 0 THEN 'n/a' ELSE concat('4', chr(10), '0') END AS value, count(*) AS n
FROM cells WHERE seven < 2 GROUP BY ALL
UNION ALL
SELECT 'lon', concat(station_id, ' west'), count(*) FROM cells WHERE five = 0 GROUP BY ALL""",
    "src_parquet": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
    "src_parquet_glob": query(
        "flown",
        "SELECT flight_id, year, origin, dest, arr_delay FROM flown WHERE year BETWEEN 1990 AND 1999",
    ),
    "sink_parquet": query("flown", CLEAN_SELECT),
    "schema_report": query(
        "flights",
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS value_count FROM flights"
            for c, t in FLIGHT_TYPES.items()
        ),
    ),
    "preview_topn": query(
        "flights",
        "SELECT flight_id, CAST(fl_date AS VARCHAR) AS fl_date, op_unique_carrier, origin, dest, distance"
        " FROM flights ORDER BY distance DESC, flight_id LIMIT 5",
    ),
    "global_sort": query(
        "flights",
        "SELECT CAST(fl_date AS VARCHAR) AS fl_date, flight_id, op_unique_carrier FROM flights"
        " ORDER BY fl_date, flight_id",
    ),
    "flights_clean": query("flown", CLEAN_SELECT),
    "delay_cause_flags": query("flights", f"SELECT flight_id, {listed(CAUSES)} FROM flights"),
    "delay_flags": query("flights", f"SELECT flight_id, {listed(LATE)} FROM flights"),
    "rush_flags": query("flights", f"SELECT flight_id, {listed(RUSH)} FROM flights"),
    "weather_parsed": query(
        "weather",
        f"SELECT station, {stamp('date')} AS date, elevation, latitude, longitude, {listed(PARSED)} FROM weather",
    ),
    "weather_clean": query(
        "observed",
        f"SELECT * REPLACE ({stamp('date')} AS date), CAST(CAST(date AS DATE) AS VARCHAR) AS date_part,"
        " CAST(hour(date) AS INTEGER) AS hour_part FROM observed",
    ),
    "region_filter": query("us_weather", OBSERVATION_KEYS),
    "union_regions": query("us_weather", OBSERVATION_KEYS),
    "bbox_filter": query("stations", f"SELECT * FROM stations WHERE {BOX.format('lat', 'lon')}"),
    "year_split": query(
        "flights",
        "SELECT flight_id, year, CASE WHEN year = 2001 THEN 'test' ELSE 'train' END AS part"
        " FROM flights WHERE year IS NOT NULL",
    ),
    "distinct_points": query("spots", "SELECT station_id AS id, lat, lon FROM spots"),
    "geo_pairs": query(
        "ports",
        "SELECT (SELECT count(*) FROM (SELECT DISTINCT station_id, lat, lon FROM stations) s"
        " CROSS JOIN (SELECT DISTINCT * FROM airports) a) AS pairs_all,"
        " (SELECT count(*) FROM spots CROSS JOIN ports) AS pairs_boxed",
    ),
    "nearest_station": query(
        "nearest", "SELECT * REPLACE (round(haversine, 6) AS haversine) FROM nearest"
    ),
    "haversine": query(
        "nearest",
        f"""SELECT flight_id, {r6(km("o.airport_lat", "o.airport_lon", "d.airport_lat", "d.airport_lon"), "route_km")}
FROM flights f JOIN nearest o ON f.origin = o.airport_id JOIN nearest d ON f.dest = d.airport_id""",
    ),
    "flight_stations": query(
        "placed",
        "SELECT flight_id, origin, dest, origin_station_id, origin_airport_lat, origin_airport_lon,"
        " dest_station_id, dest_airport_lat, dest_airport_lon FROM placed",
    ),
    "window_bounds": query(
        "flights",
        f"""SELECT flight_id, {listed([f"{stamp(c)} AS {c}" for c in ("origin_weather_start", "origin_weather_end", "dest_weather_start", "dest_weather_end")])}
FROM (SELECT flight_id, {edges("dep")}, {edges("arr")} FROM flights) w""",
    ),
    "weather_window_join": query(
        "arr_means",
        "SELECT flight_id, dep_n AS origin_matches, arr_n AS dest_matches,"
        " greatest(dep_n, 1) * greatest(arr_n, 1) AS joined_rows"
        " FROM dep_means JOIN arr_means USING (flight_id)",
    ),
    "flight_weather": query(
        "merged",
        "SELECT * REPLACE (CAST(fl_date AS VARCHAR) AS fl_date, "
        + ", ".join(r6(name, name) for name in WEATHER_MEANS)
        + ") FROM merged",
    ),
    "arrival_status": query(
        "flights",
        "SELECT CASE WHEN arr_delay > 15 OR cancelled OR diverted THEN 'delayed' ELSE 'on time' END"
        " AS arrival_status, count(*) AS n FROM flights GROUP BY 1",
    ),
    "dep_delay_by_month": query("flights", late_counts("dep_delay", "month")),
    "arr_delay_by_month": query("flights", late_counts("arr_delay", "month")),
    "dep_delay_by_block": query("flights", late_counts("dep_delay", "dep_time_blk")),
    "arr_delay_by_block": query("flights", late_counts("arr_delay", "arr_time_blk")),
    "hist_dep": histogram("dep_delay"),
    "hist_arr": histogram("arr_delay"),
    "hist_all_numeric": hist_all(),
    "corr_matrix": correlation(),
    "describe_numeric": query(
        "flights",
        per_column(
            "count({c}) AS value_count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,"
            " CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max",
            PROFILED,
        ),
    ),
    "describe_text": query(
        "flights",
        per_column(
            "count({c}) AS value_count, min({c}) AS min, max({c}) AS max",
            ["dep_time_blk", "arr_time_blk", "op_unique_carrier"],
        ),
    ),
    "delay_summary": query(
        "flights",
        per_column(
            "round(avg({c}), 6) AS mean, CAST(max({c}) AS DOUBLE) AS max, CAST(min({c}) AS DOUBLE) AS min,"
            " round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median",
            ["dep_delay", "arr_delay"],
        ),
    ),
    "carrier_share": query(
        "flights",
        "SELECT op_unique_carrier, count(*) AS n,"
        " round(count(*) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS percent"
        " FROM flights WHERE op_unique_carrier IS NOT NULL GROUP BY op_unique_carrier",
    ),
    "carrier_delay_mean": query(
        "flights",
        "SELECT op_unique_carrier, round(avg(carrier_delay), 6) AS mean_carrier_delay"
        " FROM flights GROUP BY op_unique_carrier",
    ),
    "carrier_delay_box": query("flights", box("flights", "op_unique_carrier", "carrier_delay")),
    "period_count_box": period_boxes(),
    "null_report": query(
        "merged",
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS feature_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count,"
            f" round(count(*) FILTER (WHERE {c} IS NULL) * 100 / CAST(count(*) AS DOUBLE), 2) AS null_percent FROM merged"
            for c in MERGED_COLUMNS
        ),
    ),
    "distinct_categories": query("flights", "SELECT DISTINCT op_unique_carrier FROM flights"),
    "block_code": query(
        "flights",
        f"SELECT flight_id, {block_number('dep_time_blk')} AS dep_time_blk,"
        f" {block_number('arr_time_blk')} AS arr_time_blk FROM flights",
    ),
    "lon_zone": query(
        "nearest",
        f"""SELECT flight_id, {listed(zones("origin") + zones("dest"))}
FROM (SELECT flight_id, o.airport_lon AS origin_airport_lon, d.airport_lon AS dest_airport_lon
  FROM flights f JOIN nearest o ON f.origin = o.airport_id JOIN nearest d ON f.dest = d.airport_id) p""",
    ),
    "carrier_dummies": query("flights", f"SELECT flight_id, {listed(DUMMIES)} FROM flights"),
    "category_positions": query(
        "flights",
        """
SELECT flight_id, route, coalesce(position, -1) AS position
FROM (SELECT flight_id, concat(op_unique_carrier, '-', origin, '-', dest) AS route FROM flights) f
LEFT JOIN (SELECT route, row_number() OVER (ORDER BY route) - 1 AS position FROM (
  SELECT DISTINCT concat(op_unique_carrier, '-', origin, '-', dest) AS route FROM flights WHERE year <> 2001)) k
USING (route)""",
    ),
    "surrogate_id": query(
        "flights",
        "SELECT flight_id, op_unique_carrier, row_number() OVER (ORDER BY flight_id) - 1 AS row_id FROM flights",
    ),
    "undersample_hash": query("train", "SELECT flight_id, arr_del15 FROM train"),
    "minmax_train": query(
        "ranges",
        f"SELECT flight_id, {listed([r6(scaled(c), c + '_scaled') for c in SCALED])} FROM train, ranges",
    ),
    "minmax_test": query(
        "ranges",
        f"SELECT flight_id, {listed([r6(scaled(c), c + '_scaled') for c in SCALED])} FROM test, ranges",
    ),
    "features": query(
        "ranges",
        "\nUNION ALL\n".join(
            f"SELECT flight_id, arr_del15, CAST({i} AS INTEGER) AS position,"
            f" round(CAST({scaled(SCALED_NAMES[c]) if c in SCALED_NAMES else c}"
            f" AS DOUBLE), 6) AS value FROM test, ranges"
            for i, c in enumerate(FEATURE_COLUMNS)
        ),
    ),
    "undersample": query(
        "test",
        """SELECT flight_id, arr_del15 FROM known, share WHERE year <> 2001 AND (arr_del15 = 1 OR
  CAST(concat('0x', substr(md5(CAST(flight_id AS VARCHAR)), 1, 7)) AS BIGINT) / CAST(268435456 AS DOUBLE) < share)""",
    ),
    "composite_id": query(
        "flights",
        "SELECT CAST(fl_date AS VARCHAR) AS fl_date, op_unique_carrier, origin, flight_id,"
        " row_number() OVER (ORDER BY fl_date, op_unique_carrier, flight_id) - 1 AS row_id FROM flights",
    ),
    "interval_rows": query(
        "observed_at_origin",
        "SELECT flight_id, CAST(station AS VARCHAR) AS station, CAST(date AS VARCHAR) AS date FROM observed_at_origin",
    ),
    "interval_rows_dest": query(
        "observed_at_dest",
        "SELECT flight_id, CAST(station AS VARCHAR) AS station, CAST(date AS VARCHAR) AS date FROM observed_at_dest",
    ),
    "flight_weather_any_label": any_label(),
    "confusion": query("flown", MATRIX),
    "metrics": f"""{chain("flown")}, matrix AS ({MATRIX}),
by_label AS (SELECT l.label, l.support, l.hits, coalesce(CAST(l.hits AS DOUBLE) / p.predicted, 0) AS precision,
  CAST(l.hits AS DOUBLE) / l.support AS recall
  FROM (SELECT label, CAST(sum(n) AS BIGINT) AS support, coalesce(sum(n) FILTER (WHERE label = prediction), 0) AS hits
    FROM matrix GROUP BY label) l
  LEFT JOIN (SELECT prediction, sum(n) AS predicted FROM matrix GROUP BY prediction) p ON l.label = p.prediction)
SELECT label, support, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(CAST(sum(hits) OVER () AS DOUBLE) / sum(support) OVER (), 6) AS accuracy,
  round(sum(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) * support) OVER () / CAST(sum(support) OVER () AS DOUBLE), 6) AS f1
FROM by_label""",
}
