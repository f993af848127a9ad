"""Mean weather in the hours before a time block, per station.

Two forms. ``window_means`` takes a list of blocks and gives the means of all of them:

The join of trips with all observations in their window, followed by a mean,
is turned round: observations are summed per station and slice of an hour, and
each slice is handed to the blocks whose window covers it. Windows begin and
end at few marks within an hour, so slices cut at those marks lie wholly inside
or outside of any window, and the sums are exact. No trip is touched until the
means are done, and a station with very many observations shrinks to a few rows
per hour before anything is shuffled.

``label_window_means`` takes the windows that are asked for, whatever their labels. It
sums observations per station and minute, adds these sums up over each day, and reads the
running sums at both ends of each window, which lie in the same sorted rows: one window
function over the union of sums and ends. Running sums begin anew each day, so that a
station's days are apart (no more than 2,880 sums each, besides the ends asked for) and
differences of running sums stay exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.blocks import TIME_BLOCKS, block_bounds, window_end, window_start

_MINUTE_US = 60_000_000


def _marks(blocks: Sequence[str]) -> tuple[list[int], list[int]]:
    """Minutes of the hour at which windows begin, and at which they end."""
    bounds = [block_bounds(block) for block in blocks]
    return sorted({begin % 60 for begin, _ in bounds}), sorted({end % 60 for _, end in bounds})


def _slice_of_hour(at: Column, blocks: Sequence[str]) -> Column:
    """How many marks lie behind a time: a begin mark from its instant on, an end
    mark just after it, since both ends of a window are inside."""
    begins, ends = _marks(blocks)
    seconds = F.date_part(F.lit("SECOND"), at)
    position = F.minute(at) * F.lit(_MINUTE_US).cast("long") + (seconds * 1_000_000).cast("long")
    passed = [position >= mark * _MINUTE_US for mark in begins]
    passed += [position > mark * _MINUTE_US for mark in ends]
    return sum((test.cast("int") for test in passed), F.lit(0))


def slice_sums(
    observations: DataFrame,
    measures: Sequence[str],
    blocks: Sequence[str] = TIME_BLOCKS,
    station: str = "station",
    at: str = "date",
) -> DataFrame:
    """Sum and count of each measure per station, day, hour and slice."""
    time = F.col(at)
    return observations.groupBy(
        F.col(station).alias("station"),
        F.to_date(time).alias("day"),
        F.hour(time).alias("hour"),
        _slice_of_hour(time, blocks).alias("slice"),
    ).agg(
        F.count(F.lit(1)).alias("n_obs"),
        *[F.sum(name).alias(f"sum_{name}") for name in measures],
        *[F.count(name).alias(f"n_{name}") for name in measures],
    )


def covering(
    spark: SparkSession, blocks: Sequence[str] = TIME_BLOCKS, window_hours: int = 10
) -> DataFrame:
    """Which blocks, on which day, have a window that covers an hour's slice.

    A fixed table: at most slices times blocks times hours of a window.
    """
    begins, ends = _marks(blocks)

    def passed(minute: int) -> int:
        return sum(minute >= mark for mark in begins) + sum(minute > mark for mark in ends)

    rows = []
    for code, block in enumerate(blocks):
        begin, end = block_bounds(block)
        first, last = begin // 60 - window_hours, end // 60 - 1
        for hour in range(first, last + 1):
            low = passed(begin % 60) if hour == first else 0
            high = passed(end % 60) if hour == last else len(begins) + len(ends)
            rows += [(hour % 24, part, -(hour // 24), code) for part in range(low, high + 1)]
    return spark.createDataFrame(rows, "hour int, slice int, days_on int, block int")


def window_means(
    observations: DataFrame,
    measures: Sequence[str],
    blocks: Sequence[str] = TIME_BLOCKS,
    window_hours: int = 10,
    station: str = "station",
    at: str = "date",
) -> DataFrame:
    """Mean of each measure per station, day and block (by its position in
    ``blocks``) over the block's window; only windows with an observation.

    Slices of a station's day are brought together (72 rows at the default
    blocks) before they are handed out, so that the second sum is mostly done
    ahead of its shuffle.
    """
    sums = slice_sums(observations, measures, blocks, station, at)
    shares = F.broadcast(covering(observations.sparkSession, blocks, window_hours))
    totals = (
        sums.repartition("station", "day")
        .join(shares, ["hour", "slice"])
        .groupBy("station", F.date_add("day", F.col("days_on")).alias("window_day"), "block")
        .agg(
            F.sum("n_obs").alias("n_obs"),
            *[
                F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}")).alias(name)
                for name in measures
            ],
        )
    )
    return totals


def _minute(at: Column) -> Column:
    return F.hour(at) * 60 + F.minute(at)


def requested_windows(requests: DataFrame, window_hours: int = 10) -> DataFrame:
    """(station, day, label, start, end) of the requests whose window is not empty.

    A label is ``hhmm-hhmm`` with any minutes. One that is none, or NULL, has no window.
    """
    day, label = F.col("day"), F.col("label")
    bounds = {"start": window_start(day, label, window_hours), "end": window_end(day, label)}
    return requests.select("station", "day", "label").distinct().withColumns(bounds).filter("start <= end")


def label_window_means(
    observations: DataFrame,
    windows: DataFrame,
    measures: Sequence[str],
    station: str = "station",
    at: str = "date",
) -> DataFrame:
    """Mean of each measure per station, day and label over the window asked for; only
    windows with an observation.

    ``windows`` are those of ``requested_windows``; both their ends are inside. Gives station,
    day, label, n_obs and the measures.
    """
    time = F.col(at)
    # Twice the minute of the day, and one more just after it: an end on a minute's first
    # instant holds what was seen at that instant, and nothing later.
    place = 2 * _minute(time) + (F.date_part(F.lit("SECOND"), time) > 0).cast("int")
    counts = ["n_obs", *(f"{kind}_{name}" for name in measures for kind in ("sum", "n"))]
    sums = observations.groupBy(
        F.col(station).alias("station"), F.to_date(time).alias("on"), place.alias("place")
    ).agg(
        F.count(F.lit(1)).alias("n_obs"),
        *[
            found
            for name in measures
            for found in (
                F.coalesce(F.sum(name), F.lit(0.0)).alias(f"sum_{name}"),
                F.count(name).alias(f"n_{name}"),
            )
        ],
    )
    # Each day that a window touches, with the first and last place inside it.
    start, end = F.to_date("start"), F.to_date("end")
    days = windows.withColumn("on", F.explode(F.sequence(start, end))).withColumns(
        {
            "low": F.when(F.col("on") == start, 2 * _minute(F.col("start"))).otherwise(0),
            "high": F.when(F.col("on") == end, 2 * _minute(F.col("end"))).otherwise(2 * 1440),
        }
    )
    # What lies before the first place is taken off what lies up to the last one.
    edges = days.select(
        "station", "on", "day", "label",
        F.inline(
            F.array(
                F.struct(F.col("low").alias("place"), F.lit(0).alias("turn"), F.lit(-1).alias("sign")),
                F.struct(F.col("high").alias("place"), F.lit(2).alias("turn"), F.lit(1).alias("sign")),
            )
        ),
    )
    line = sums.withColumn("turn", F.lit(1)).unionByName(edges, allowMissingColumns=True)
    so_far = (
        Window.partitionBy("station", "on")
        .orderBy("place", "turn")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    read = line.select(
        "station", "day", "label", "sign", *[F.sum(c).over(so_far).alias(c) for c in counts]
    ).filter("sign IS NOT NULL")
    totals = read.groupBy("station", "day", "label").agg(
        *[F.coalesce(F.sum(F.col("sign") * F.col(c)), F.lit(0)).alias(c) for c in counts]
    )
    return totals.filter("n_obs > 0").select(
        "station", "day", "label", "n_obs",
        *[F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}")).alias(name) for name in measures],
    )
