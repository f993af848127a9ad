"""Helpers for the tests of this folder."""

from __future__ import annotations

import duckdb


def table(sf_dir: str, name: str) -> list[tuple]:
    return duckdb.sql(f"SELECT * FROM '{sf_dir}/{name}.parquet'").fetchall()


def saved(spark, folder, rows, schema: str, name: str = "documents") -> str:
    """Rows written as a table of a folder; the folder's path."""
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(texts, lang="en"):
    """Document rows with ids from 0."""
    return [(i, t, lang, "s", None if t is None else len(t)) for i, t in enumerate(texts)]
