"""Time the headline queries; prints one JSON line.

Each query runs twice and its better time counts, so that the start of the JVM
is left out. ``merge_written`` is the merge of flights and weather with its
write, which later queries read back.
"""

from __future__ import annotations

import json
import os
import time

from skylag.plans.catalog import QUERIES, merged_table, stored_merges
from skylag.session import build_session

HEADLINE = [
    "nearest_station",
    "flight_weather",
    "weather_window_join",
    "weather_clean",
    "flights_clean",
    "null_report",
    "corr_matrix",
    "hist_all_numeric",
    "hist_dep",
    "carrier_delay_box",
    "delay_summary",
    "arrival_status",
    "surrogate_id",
    "minmax_train",
    "undersample_hash",
    "metrics",
    "sink_parquet",
    "lr_base",
    "dt_cv",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderpriority").count().collect()
    seconds = {}

    def timed(name: str, run) -> None:
        begun = time.perf_counter()
        run()
        took = round(time.perf_counter() - begun, 3)
        seconds[name] = min(took, seconds.get(name, took))

    def merge() -> None:
        stored_merges.clear()
        merged_table(spark, sf_dir)

    for _ in range(2):
        timed("merge_written", merge)
        for name in HEADLINE:
            query = QUERIES[name]
            timed(name, lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
