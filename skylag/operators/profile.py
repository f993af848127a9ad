"""Profiles of a table: nulls, summaries, histograms, correlations, shares."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import sql_over
from .quantiles import MOST, quantiles


# Per pair of columns, over the rows that have both: count, means, and sums of squares and of
# products of what values differ from the means.
_MOMENTS = ("n", "x", "y", "xx", "yy", "xy")

# Two sets of moments as those of both together, as SQL.
_MERGED = """
named_struct('n', a.n + b.n,
  'x', a.x + (b.x - a.x) * coalesce(try_divide(b.n, a.n + b.n), 0D),
  'y', a.y + (b.y - a.y) * coalesce(try_divide(b.n, a.n + b.n), 0D),
  'xx', a.xx + b.xx + (b.x - a.x) * (b.x - a.x) * coalesce(try_divide(a.n * b.n, a.n + b.n), 0D),
  'yy', a.yy + b.yy + (b.y - a.y) * (b.y - a.y) * coalesce(try_divide(a.n * b.n, a.n + b.n), 0D),
  'xy', a.xy + b.xy + (b.x - a.x) * (b.y - a.y) * coalesce(try_divide(a.n * b.n, a.n + b.n), 0D))
"""


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _one_row_per_column(
    df: DataFrame, names: Sequence[str], facts: dict[str, str]
) -> DataFrame:
    """Aggregate all columns in one pass, then turn the wide row into one per column.

    ``facts`` maps an output name to an SQL aggregate in which ``{c}`` is the column.
    """
    row = df.selectExpr(
        *[
            f"{fact.format(c=f'`{name}`', name=name)} AS `{i}_{key}`"
            for i, name in enumerate(names)
            for key, fact in facts.items()
        ]
    )
    entries = ", ".join(
        f"struct('{name}' AS column_name, " + ", ".join(f"`{i}_{key}` AS {key}" for key in facts) + ")"
        for i, name in enumerate(names)
    )
    return row.selectExpr(f"inline(array({entries}))")


def _one_row_per_value(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns (column_name, value), a row for each cell of the named columns."""
    entries = ", ".join(
        f"struct('{name}' AS column_name, CAST(`{name}` AS DOUBLE) AS value)" for name in names
    )
    return df.selectExpr(f"inline(array({entries}))")


def null_report(df: DataFrame) -> DataFrame:
    """NULLs per column and their share in percent, in a single pass."""
    counted = _one_row_per_column(
        df, df.columns, {"rows": "count(1)", "null_count": "count_if({c} IS NULL)"}
    )
    return counted.selectExpr(
        "column_name AS feature_name",
        "null_count",
        "round(try_divide(null_count * 100, rows), 2) AS null_percent",
    )


def schema_report(df: DataFrame) -> DataFrame:
    """Name and type of each column, with how many of its values are set."""
    counted = _one_row_per_column(df, df.columns, {"value_count": "count({c})"})
    types = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}'" for f in df.schema.fields)
    return counted.selectExpr(
        "column_name", f"element_at(map({types}), column_name) AS data_type", "value_count"
    )


def describe_numeric(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, least and greatest of each numeric column."""
    return _one_row_per_column(
        df,
        names or numeric_columns(df),
        {
            "value_count": "count({c})",
            "mean": "avg({c})",
            "stddev": "stddev_samp({c})",
            "min": "CAST(min({c}) AS DOUBLE)",
            "max": "CAST(max({c}) AS DOUBLE)",
        },
    )


def describe_text(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Count, first and last value in order of each text column."""
    return _one_row_per_column(
        df,
        names or text_columns(df),
        {"value_count": "count({c})", "min": "min({c})", "max": "max({c})"},
    )


def summary(df: DataFrame, names: Sequence[str], most: int = MOST) -> DataFrame:
    """Mean, median, greatest and least of some columns; ``most`` as for ``quantiles``."""
    plain = _one_row_per_column(
        df,
        names,
        {
            "mean": "avg({c})",
            "max": "CAST(max({c}) AS DOUBLE)",
            "min": "CAST(min({c}) AS DOUBLE)",
        },
    )
    values = _one_row_per_value(df, names)
    medians = quantiles(values, "value", {"median": 0.5}, ["column_name"], most)
    return plain.join(medians.select("column_name", "median"), "column_name", "left")


def share(df: DataFrame, column: str) -> DataFrame:
    """Count of each value and its percentage, NULL left out."""
    counts = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.col("n") * 100 / total).orderBy(F.desc("n"), column)


def mean_by(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(group).agg(F.avg(value).alias(f"mean_{value}"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def _merged(one: list[np.ndarray] | None, other: list[np.ndarray]) -> list[np.ndarray]:
    """Moments of two sets of rows as those of both together."""
    if one is None:
        return other
    n = one[0] + other[0]
    part = np.divide(other[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy, weight = other[1] - one[1], other[2] - one[2], one[0] * part
    return [
        n,
        one[1] + dx * part,
        one[2] + dy * part,
        one[3] + other[3] + dx * dx * weight,
        one[4] + other[4] + dy * dy * weight,
        one[5] + other[5] + dx * dy * weight,
    ]


def _moments_of(raw: np.ndarray) -> list[np.ndarray]:
    """Moments of all pairs of the columns of a matrix; NaN is a missing value.

    Values are measured from the means of their columns here. A column with an infinite value
    has no moments.
    """
    infinite = np.isinf(raw).any(axis=0)
    raw = np.where(np.isinf(raw), np.nan, raw)
    there = (~np.isnan(raw)).astype("float64")
    counts = there.sum(axis=0)
    centre = np.divide(np.nansum(raw, axis=0), counts, out=np.zeros(len(counts)), where=counts > 0)
    x = np.nan_to_num(raw - centre)
    n, sums = there.T @ there, x.T @ there
    means = np.divide(sums, n, out=np.zeros_like(n), where=n > 0)
    squares = (x * x).T @ there - sums * means
    squares[infinite] = np.nan
    away = centre[:, None] + means
    return [n, away, away.T, squares, squares.T, x.T @ x - sums * means.T]


def correlations(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each pair of columns over the rows that have both.

    One pass: the moments of all pairs are matrix products, taken per Arrow batch about the
    batch's own means and merged pairwise, so that large values lose no digits. A task
    hands on one row per pair, and these few are merged in the same way. A pair with a
    constant column has no correlation (NULL), and neither has one with a column that holds
    an infinite value; NaN counts as missing.
    """
    names = list(names or numeric_columns(df))
    values = df.selectExpr(*[f"CAST(`{name}` AS DOUBLE) AS `{name}`" for name in names])
    upper = np.triu_indices(len(names))

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                total = _merged(total, _moments_of(batch.to_numpy(dtype="float64")))
        if total is None:
            total = [np.zeros((len(names), len(names)))] * len(_MOMENTS)
        columns = dict(zip(_MOMENTS, (table[upper] for table in total)))
        yield pd.DataFrame({"i": upper[0], "j": upper[1], **columns})

    schema = "i int, j int, " + ", ".join(f"{name} double" for name in _MOMENTS)
    none = "named_struct(" + ", ".join(f"'{name}', 0D" for name in _MOMENTS) + ")"
    merged = (
        values.mapInPandas(moments, schema)
        .groupBy("i", "j")
        .agg(F.collect_list(F.struct(*_MOMENTS)).alias("parts"))
        .selectExpr("i", "j", f"inline(array(aggregate(parts, {none}, (a, b) -> {_MERGED})))")
    )
    labels = ", ".join(f"'{name}'" for name in names)
    half = merged.selectExpr(
        "i",
        "j",
        # What is left of a constant column is rounding noise.
        "if(xx > 1e-28 * n * x * x AND yy > 1e-28 * n * y * y AND NOT isnan(xx) AND NOT isnan(yy),"
        " xy / sqrt(xx * yy), NULL) AS r",
    )
    both = half.selectExpr("i", "j", "r", "explode(if(i = j, array(0), array(0, 1))) AS side")
    return both.selectExpr(
        f"get(array({labels}), if(side = 0, i, j)) AS column_a",
        f"get(array({labels}), if(side = 0, j, i)) AS column_b",
        "r",
    )


def status_counts(df: DataFrame, status: str) -> DataFrame:
    """Rows per status, most frequent first, as SQL over a view."""
    return sql_over(
        df.sparkSession,
        {"status_rows": df},
        f"SELECT `{status}`, count(*) AS n FROM {{status_rows}} GROUP BY `{status}` ORDER BY n DESC",
    )


def late_counts(df: DataFrame, delay: str, period: str, late_after: float = 15) -> DataFrame:
    """Late flights per month or time block, as SQL over a view."""
    return sql_over(
        df.sparkSession,
        {"flight_rows": df},
        f"SELECT `{period}`, count(`{delay}`) AS delay_counts FROM {{flight_rows}} "
        f"WHERE `{delay}` > {late_after} GROUP BY `{period}` ORDER BY `{period}`",
    )


def ordinary_delays(df: DataFrame, delay: str, below: float = 120) -> DataFrame:
    """Delays of flights that took place, above 0 and below ``below`` minutes."""
    value = F.col(delay)
    return df.filter(
        value.isNotNull() & ~F.col("cancelled") & ~F.col("diverted") & (value < below) & (value > 0)
    ).selectExpr(delay)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram from the least to the greatest value, empty bins too.

    The last bin holds its upper edge. Two passes: the extent, of which two
    numbers come back, and the counts.
    """
    known = df.selectExpr(f"CAST(`{column}` AS DOUBLE) AS value").filter("value IS NOT NULL")
    low, high = known.agg(F.min("value"), F.max("value")).first()
    width = None if low is None else (high - low) / bins
    low, high, width = (F.lit(number).cast("double") for number in (low, high, width))
    place = F.floor(F.try_divide(F.col("value") - low, width))
    place = F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(0)).cast("int")
    counts = known.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    last = F.col("bin") == bins - 1
    # No more counts than bins.
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_low"),
        F.when(last, high).otherwise(low + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def histograms(df: DataFrame, names: Sequence[str] | None = None, bins: int = 50) -> DataFrame:
    """Histogram of each numeric column over its own extent.

    Bins are taken from their edges, and a column with one value gets an extent
    of one around it. Two passes: the extents, and the counts, for which each
    row is unfolded next to the partial aggregate.
    """
    names = list(names or numeric_columns(df))
    extents = _one_row_per_column(
        df,
        names,
        {"least": "CAST(min({c}) AS DOUBLE)", "greatest": "CAST(max({c}) AS DOUBLE)"},
    )
    single = F.col("least") == F.col("greatest")
    extents = extents.filter(F.col("least").isNotNull()).select(
        "column_name",
        F.when(single, F.col("least") - 0.5).otherwise(F.col("least")).alias("low"),
        F.when(single, F.col("greatest") + 0.5).otherwise(F.col("greatest")).alias("high"),
    ).withColumn("width", (F.col("high") - F.col("low")) / bins)
    long = _one_row_per_value(df, names).filter("value IS NOT NULL")
    first = F.least(
        F.floor((F.col("value") - F.col("low")) / F.col("width")), F.lit(bins - 1)
    ).cast("int")
    edge = F.col("low") + F.col("bin") * F.col("width")
    next_edge = F.col("low") + (F.col("bin") + 1) * F.col("width")
    settled = (
        F.when(F.col("value") < edge, F.col("bin") - 1)
        .when((F.col("value") >= next_edge) & (F.col("bin") < bins - 1), F.col("bin") + 1)
        .otherwise(F.col("bin"))
    )
    counts = (
        long.join(F.broadcast(extents), "column_name")
        .withColumn("bin", first)
        .withColumn("bin", settled)
        .groupBy("column_name", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = extents.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(counts, ["column_name", "bin"], "left").select(
        "column_name",
        "bin",
        edge.alias("bin_low"),
        F.when(F.col("bin") == bins - 1, F.col("high")).otherwise(next_edge).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
