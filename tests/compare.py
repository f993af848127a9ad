"""Compare a query's Spark result with its SQL twin on DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _rows(frame: pd.DataFrame) -> Counter:
    ordered = frame[sorted(frame.columns)]
    return Counter(
        tuple("NULL" if pd.isna(v) else repr(v) for v in row)
        for row in ordered.astype(object).itertuples(index=False, name=None)
    )


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> list[str]:
    """What differs: columns, types, or rows (regardless of order)."""
    found = []
    left, right = sorted(spark_frame.columns), sorted(sql_frame.columns)
    if left != right:
        return [f"columns {left} against {right}"]
    for name in left:
        if spark_frame[name].dtype != sql_frame[name].dtype:
            found.append(f"type of {name}: {spark_frame[name].dtype}, {sql_frame[name].dtype}")
    mine, other = _rows(spark_frame), _rows(sql_frame)
    if mine != other:
        extra, missing = mine - other, other - mine
        found.append(
            f"{len(spark_frame)} rows against {len(sql_frame)};"
            f" only here {sum(extra.values())} {list(extra)[:3]};"
            f" only there {sum(missing.values())} {list(missing)[:3]}"
        )
    return found
