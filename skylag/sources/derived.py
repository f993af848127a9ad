"""Flights, airports, stations and weather derived from the star-schema tables.

The texts run on Spark and on DuckDB alike; the braces name the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLIGHTS_SQL = """
SELECT flight_id, year, month, day_of_week, fl_day, carrier, origin, dest, dep_hour, arr_hour,
  dep_hour*100 + ck % 60 AS dep_time, arr_hour*100 + ck % 60 AS arr_time,
  CASE WHEN dep_hour < 6 THEN '0001-0559' ELSE concat(lpad(CAST(dep_hour AS VARCHAR(2)),2,'0'),'00-',lpad(CAST(dep_hour AS VARCHAR(2)),2,'0'),'59') END AS dep_time_blk,
  CASE WHEN arr_hour < 6 THEN '0001-0559' ELSE concat(lpad(CAST(arr_hour AS VARCHAR(2)),2,'0'),'00-',lpad(CAST(arr_hour AS VARCHAR(2)),2,'0'),'59') END AS arr_time_blk,
  dep_delay, dep_delay + ck % 21 - 10 AS arr_delay,
  CASE WHEN dep_delay > 15 AND flight_id % 5 = 0 THEN dep_delay END AS carrier_delay,
  CASE WHEN dep_delay > 15 AND flight_id % 5 = 1 THEN dep_delay END AS weather_delay,
  CASE WHEN dep_delay > 15 AND flight_id % 5 = 2 THEN dep_delay END AS nas_delay,
  CASE WHEN dep_delay > 15 AND flight_id % 5 = 3 THEN dep_delay END AS security_delay,
  CASE WHEN dep_delay > 15 AND flight_id % 5 = 4 THEN dep_delay END AS late_aircraft_delay,
  cancelled, diverted, 45 + flight_id % 300 AS crs_elapsed_time, 100 + (flight_id*17) % 2500 AS distance
FROM (
  SELECT *, CASE WHEN flight_id % 50 = 0 THEN NULL
    WHEN p % 10 < 1 + CASE WHEN month IN (6,7,8) THEN 2 ELSE 0 END + CASE WHEN dep_hour BETWEEN 15 AND 20 THEN 3 ELSE 0 END THEN 16 + p10 % 134
    ELSE p10 % 35 - 20 END AS dep_delay
  FROM (
    SELECT o_orderkey AS flight_id, o_custkey AS ck, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
      CAST(1 + o_orderkey % 7 AS INT) AS day_of_week, CAST(o_orderkey % 30 AS INT) AS fl_day,
      concat('C', substr(o_orderpriority,1,1)) AS carrier, o_custkey % 25 AS origin, (o_orderkey*7+3) % 25 AS dest,
      CAST((o_orderkey*13) % 24 AS INT) AS dep_hour, CAST(((o_orderkey*13) % 24 + 1 + o_custkey % 6) % 24 AS INT) AS arr_hour,
      (o_orderkey % 53 = 0) AS cancelled, (o_orderkey % 97 = 0) AS diverted,
      CAST(floor(o_totalprice) AS BIGINT) AS p, CAST(floor(o_totalprice/10) AS BIGINT) AS p10
    FROM {orders}) a) b
"""

AIRPORTS_SQL = """
SELECT n_nationkey AS airport_id, 22 + ((n_nationkey*7) % 29) + 0.25e0 AS lat,
  -126 + ((n_nationkey*11) % 66) + 0.5e0 AS lon FROM {nation}
"""

WEATHER_SQL = """
SELECT event_id, user_id AS station, ts AS date,
  20 + ((user_id*37) % 350)/1e1 AS latitude, -130 + ((user_id*53) % 720)/1e1 AS longitude, (user_id % 90)*1e1 AS elevation,
  CASE WHEN event_id % 59 = 0 THEN '' ELSE concat(lpad(CAST(CASE WHEN event_id % 41 = 0 THEN 999 ELSE event_id % 361 END AS VARCHAR(9)),3,'0'), ',1,N,',
    lpad(CAST(CASE WHEN event_id % 43 = 0 THEN 9999 ELSE CAST(floor(value) AS BIGINT) END AS VARCHAR(9)),4,'0'), ',1') END AS wnd,
  concat(lpad(CAST(CASE WHEN event_id % 37 = 0 THEN 99999 ELSE (event_id*31) % 22000 END AS VARCHAR(9)),5,'0'), ',9,9,N') AS cig,
  concat(lpad(CAST(CASE WHEN event_id % 31 = 0 THEN 999999 ELSE (event_id*29) % 16093 END AS VARCHAR(9)),6,'0'), ',1,N,1') AS vis,
  concat(CASE WHEN event_id % 2 = 0 THEN '+' ELSE '-' END, lpad(CAST(CASE WHEN event_id % 94 = 0 THEN 9999 ELSE event_id % 400 END AS VARCHAR(9)),4,'0'), ',1') AS tmp,
  concat(CASE WHEN event_id % 3 = 0 THEN '-' ELSE '+' END, lpad(CAST(CASE WHEN event_id % 3 <> 0 AND event_id % 61 = 0 THEN 9999 ELSE event_id % 250 END AS VARCHAR(9)),4,'0'), ',1') AS dew,
  concat(lpad(CAST(CASE WHEN event_id % 29 = 0 THEN 99999 ELSE 9800 + event_id % 600 END AS VARCHAR(9)),5,'0'), ',1') AS slp
FROM {events}
"""

FIRST_DAY = "2024-01-01"
TEST_YEAR = 2001
CARRIERS = ["C1", "C2", "C3", "C4", "C5"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, in the columns of the on-time performance records."""
    rows = spark.sql(FLIGHTS_SQL, orders=table(spark, sf_dir, "orders"))
    return rows.withColumnRenamed("carrier", "op_unique_carrier").withColumns(
        {
            "fl_date": F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("fl_day")),
            "crs_dep_time": F.col("dep_hour") * 100,
            "crs_arr_time": F.col("arr_hour") * 100,
        }
    ).drop("fl_day", "dep_hour", "arr_hour")


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(AIRPORTS_SQL, nation=table(spark, sf_dir, "nation"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rows per supplier, one for each region key, as in a neighbour table."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("station_id"),
        (20 + ((key * 37) % 350) / F.lit(10.0)).alias("lat"),
        (-130 + ((key * 53) % 720) / F.lit(10.0)).alias("lon"),
        F.explode(F.sequence(F.lit(0), F.lit(4))).alias("neighbor_id"),
    )


def finished(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same rows, with the named columns computed once and for all.

    They pass through a generator of one row, which stands for the scan of a
    stored table. Otherwise the derivation would be repeated inside every filter
    and column that reads it, and grow into one function with the joins above.
    """
    others = [name for name in df.columns if name not in columns]
    rows = F.transform(F.array(F.struct(*columns)), lambda row: row)
    return df.select(*others, F.inline(rows))


PACKED = ["wnd", "cig", "vis", "tmp", "dew", "slp"]


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per event. Filters on time and place act before the packed
    strings are made."""
    rows = spark.sql(WEATHER_SQL, events=table(spark, sf_dir, "events"))
    return finished(rows, PACKED)
