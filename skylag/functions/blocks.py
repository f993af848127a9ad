"""Time blocks of the day and the weather windows that belong to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# One block for the night, then one per hour from six on.
TIME_BLOCKS = ["0001-0559"] + [f"{hour:02d}00-{hour:02d}59" for hour in range(6, 24)]


def block_code(label: Column, blocks: Sequence[str] = TIME_BLOCKS) -> Column:
    """Position of a block label in ``blocks``, from 0; NULL when it is not listed."""
    position = F.array_position(F.array(*[F.lit(block) for block in blocks]), label)
    return F.when(position > 0, (position - 1).cast("int"))


def known_block_code(label: Column, blocks: Sequence[str] = TIME_BLOCKS) -> Column:
    """As ``block_code``, but a label that is not listed stops the job.

    Joins on block codes use it, because a label outside the list would
    otherwise lose its weather without notice. A NULL label stays NULL.
    """
    unknown = F.raise_error(F.concat(F.lit("time block is not in the list: "), label))
    code = block_code(label, blocks)
    return F.when(label.isNull(), F.lit(None).cast("int")).otherwise(
        F.coalesce(code, unknown.cast("int"))
    )


def _minutes(label: Column, start: int) -> Column:
    hours = F.substring(label, start, 2).try_cast("int")
    return hours * 60 + F.substring(label, start + 2, 2).try_cast("int")


def window_start(day: Column, label: Column, window_hours: int = 10) -> Column:
    """Begin of the block on ``day``, moved ``window_hours`` back."""
    minutes = _minutes(label, 1) - 60 * window_hours
    return F.timestamp_add("MINUTE", minutes, day.cast("timestamp_ntz"))


def window_end(day: Column, label: Column) -> Column:
    """End of the block on ``day``, moved one hour back; the end itself is inside."""
    return F.timestamp_add("MINUTE", _minutes(label, 6) - 60, day.cast("timestamp_ntz"))


def block_bounds(label: str) -> tuple[int, int]:
    """Minutes of the day at which a label's block begins and ends."""
    begin, end = label.split("-")
    return int(begin[:2]) * 60 + int(begin[2:]), int(end[:2]) * 60 + int(end[2:])
