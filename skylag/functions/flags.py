"""0/1 flags and safe parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(test: Column) -> Column:
    """1 where the test holds, 0 where it fails or is unknown."""
    return F.coalesce(test, F.lit(False)).cast("int")


def is_rush_month(month: Column) -> Column:
    return flag(month.isin(6, 7, 8))


def is_departure_rush(hhmm: Column) -> Column:
    return flag(hhmm.between(1500, 2000))


def is_arrival_rush(hhmm: Column) -> Column:
    return flag(hhmm.between(1600, 2200))


def is_late(delay: Column, late_after: float = 15) -> Column:
    """Strictly more than ``late_after`` minutes."""
    return flag(delay > late_after)


def packed_number(packed: Column, position: int) -> Column:
    """The number at ``position`` of a comma-packed field; NULL if it is none."""
    if position == 0:
        text = F.substring_index(packed, ",", 1)
    else:
        text = F.get(F.split(packed, ","), position)
    return text.try_cast("double")
