"""Row numbers for a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize


def with_row_id(
    df: DataFrame, key: str | Sequence[str], name: str = "row_id", parts: int | None = None
) -> DataFrame:
    """Number the rows from 0 in the order of a unique key of one column or several.

    Rows are dealt out by ranges of the key and written with the number of their range.
    A count of each range gives the number of rows before it, and rows are numbered
    within their range. Ranges follow the key, so the ids do not hang on how the table
    was partitioned. NULLs come first; a repeated key makes the order of its rows open.
    """
    key = [key] if isinstance(key, str) else list(key)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *key).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range, no more than there are partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*key))
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_before") + within - 1)
        .drop("_range", "_before")
    )
