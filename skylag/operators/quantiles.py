"""Exact quantiles and five-number summaries per group, by selection.

A quantile is one or two ranks of a group. For each rank an open interval of values is known
that holds it, with the exact number of rows before it and inside it; at first that is
everything. A round looks at the rows inside the intervals twice: a sketch of bounded size
gives some hundred cuts, and exact counts about the two cuts next to the rank say on which
side of them, or at which of them, it lies. Sketches only choose where to look, so their error
costs a round at worst, never the result. When no interval holds more than ``most``
rows, the values inside are counted and the rank is read off.

Rows never move but as counts: a round hands on a sketch or five counts for each rank and
task, and the last step at most ``most`` values a rank, however many values the
column has and however many rows a group holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import BROADCAST_ROWS, broadcast_if_small, materialize

# Rows inside the interval of a rank that one task may sort.
MOST = 100_000

# Cuts taken in a round.
CUTS = 256


def _inside(rows: DataFrame, ranks: DataFrame, group: Sequence[str], few: bool) -> DataFrame:
    """Each row with the ranks of its group in whose interval it lies; ``few`` ranks are broadcast."""
    above = F.col("low").isNull() | (F.col("v") > F.col("low"))
    below = F.col("high").isNull() | (F.col("v") < F.col("high"))
    return rows.join(F.broadcast(ranks) if few else ranks, list(group)).filter(above & below)


def _narrowed(rows: DataFrame, ranks: DataFrame, group: Sequence[str], few: bool) -> DataFrame:
    """The same ranks with smaller intervals, or with the value found."""
    key = [*group, "rank"]
    shares = [i / (CUTS + 1) for i in range(1, CUTS + 1)]
    cuts = _inside(rows, ranks, group, few).groupBy(*key).agg(
        F.percentile_approx("v", shares).alias("cuts")
    )
    # The rank's place among the cuts, and a cut further on both sides.
    place = ((F.col("rank") - F.col("before")) * (CUTS + 1) / F.col("inside")).cast("int")
    cut = ranks.join(cuts, key).select(
        *ranks.columns,
        F.get("cuts", F.greatest(place - 2, F.lit(0))).alias("a"),
        F.get("cuts", F.least(place + 1, F.lit(CUTS - 1))).alias("b"),
    )
    cut = materialize(cut, "cuts")

    v, a, b = F.col("v"), F.col("a"), F.col("b")
    counted = _inside(rows, cut, group, few).groupBy(*key).agg(
        F.count_if(v < a).alias("under"),
        F.count_if(v == a).alias("at_a"),
        F.count_if((v > a) & (v < b)).alias("between"),
        F.count_if((v == b) & (a < b)).alias("at_b"),
    )
    ends = cut.join(counted, key)
    # Ranks at which the parts end.
    last = "before"
    for name, width in (("e1", "under"), ("e2", "at_a"), ("e3", "between"), ("e4", "at_b")):
        ends = ends.withColumn(name, F.col(last) + F.col(width))
        last = name
    rank = F.col("rank")

    def by_part(under, at_a, between, at_b, over) -> Column:
        return (
            F.when(rank < F.col("e1"), under)
            .when(rank < F.col("e2"), at_a)
            .when(rank < F.col("e3"), between)
            .when(rank < F.col("e4"), at_b)
            .otherwise(over)
        )

    low, high, none = F.col("low"), F.col("high"), F.lit(None).cast("double")
    return ends.select(
        *key,
        by_part(low, low, a, low, b).alias("low"),
        by_part(a, high, b, high, high).alias("high"),
        by_part(F.col("before"), F.col("e1"), F.col("e2"), F.col("e3"), F.col("e4")).alias("before"),
        by_part(
            F.col("under"), F.col("at_a"), F.col("between"), F.col("at_b"),
            F.col("before") + F.col("inside") - F.col("e4"),
        ).alias("inside"),
        by_part(none, a, none, b, none).alias("found"),
    )


def _open(ranks: DataFrame, group: Sequence[str]) -> DataFrame:
    """Ranks of which nothing is known yet."""
    none = F.lit(None).cast("double")
    return ranks.select(
        *group,
        "rank",
        none.alias("low"),
        none.alias("high"),
        F.lit(0).cast("long").alias("before"),
        F.col("n").alias("inside"),
        none.alias("found"),
    )


def bounded_ranks(
    rows: DataFrame, ranks: DataFrame, group: Sequence[str], most: int = MOST, few: bool = True
) -> DataFrame:
    """Intervals of at most ``most`` rows, or values, for all ranks (group, rank, n).

    Rows are (group, v) without NULLs. Ranks count from 0; ``few`` says that they may be broadcast.
    Gives group, rank, low, high, before, inside, found.
    """
    settled = []
    state = materialize(_open(ranks, group), "ranks")
    wide = F.col("found").isNull() & (F.col("inside") > most)
    while not state.filter(wide).isEmpty():
        settled.append(state.filter(~wide))
        state = materialize(_narrowed(rows, state.filter(wide), group, few), "ranks")
    for before in settled:
        state = state.unionByName(before)
    return state


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    group: Sequence[str],
    most: int = MOST,
) -> DataFrame:
    """Exact interpolated quantiles of a column per group, by output name.

    NULL values do not count, groups without a value give no row, and neither do NULL groups.
    ``most`` bounds what one task sorts; the result is the same.
    """
    rows = df.select(*group, F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    sizes = materialize(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n")), "sizes")
    places = {name: (F.col("n") - 1) * F.lit(p) for name, p in probabilities.items()}
    both = [edge(place).cast("long") for place in places.values() for edge in (F.floor, F.ceil)]
    ranks = sizes.select(*group, "n", F.explode(F.array_distinct(F.array(*both))).alias("rank"))
    groups, largest = sizes.agg(F.count(F.lit(1)), F.max("n")).first()
    few = groups * len(both) <= BROADCAST_ROWS
    bounded = bounded_ranks(rows, ranks, group, most, few) if (largest or 0) > most else _open(ranks, group)

    key = [*group, "rank"]
    upward = Window.partitionBy(*key).orderBy("v")
    read = (
        _inside(rows, bounded.filter("found IS NULL"), group, few)
        .groupBy(*key, "before", "v")
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("past", F.col("before") + F.sum("times").over(upward))
        .filter("past > rank")
        .groupBy(*key)
        .agg(F.min("v").alias("found"))
    )
    found = read.unionByName(bounded.filter("found IS NOT NULL").select(*key, "found"))
    at_rank = [
        F.max(F.when(F.col("rank") == edge(place).cast("long"), F.col("found"))).alias(f"{name}_{side}")
        for name, place in places.items()
        for side, edge in (("low", F.floor), ("high", F.ceil))
    ]
    picked = found.join(sizes, list(group)).groupBy(*group, "n").agg(*at_rank)
    return picked.select(
        *group,
        "n",
        *[
            (
                F.col(f"{name}_low")
                + (place - F.floor(place)) * (F.col(f"{name}_high") - F.col(f"{name}_low"))
            ).alias(name)
            for name, place in places.items()
        ],
    )


def box_summary(
    df: DataFrame, group: str, value: str, reach: float = 1.5, most: int = MOST
) -> DataFrame:
    """Quartiles, whiskers and outliers per group, as a box plot draws them.

    Whiskers end at the last value within ``reach`` interquartile ranges.
    """
    quartiles = quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group], most)
    quartiles = broadcast_if_small(materialize(quartiles, "quartiles"))
    rows = df.select(group, F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    margin = (F.col("q3") - F.col("q1")) * reach
    inside = F.col("v").between(F.col("q1") - margin, F.col("q3") + margin)
    return (
        rows.join(quartiles, group)
        .groupBy(group)
        .agg(
            F.max("n").alias("n"),
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )
