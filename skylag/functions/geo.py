"""Distances and regions on the globe."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


class Box(NamedTuple):
    """A region between two parallels and two meridians; its edges are outside."""

    west: float
    south: float
    east: float
    north: float

    def holds(self, lat: Column, lon: Column) -> Column:
        return (lat > self.south) & (lat < self.north) & (lon > self.west) & (lon < self.east)


# The box in which airports and stations are paired.
LOWER_48 = Box(west=-127.23, south=24.45, east=-60.04, north=49.46)

WORLD = Box(west=-180.1, south=-90.1, east=180.1, north=90.1)

# The boxes that make up the United States for weather rows.
# They are pairwise disjoint, so a row lies in one of them at most.
US_BOXES = [
    Box(west=-125, south=24, east=-67, north=49),
    Box(west=-68, south=17, east=-65.5, north=19),
    Box(west=144, south=13, east=145, north=14),
    Box(west=145, south=15, east=146, north=16),
    Box(west=-171, south=-15, east=-170, north=-14),
    Box(west=-65.4, south=18, east=-64, north=19),
    Box(west=-160, south=18, east=-154, north=23),
    Box(west=-170, south=50, east=-103, north=175),
]


def in_any_box(lat: Column, lon: Column, boxes: list[Box] = US_BOXES) -> Column:
    """True where the point lies in one of the boxes."""
    return reduce(Column.__or__, [box.holds(lat, lon) for box in boxes])


def arc_km(half_chord_squared: Column) -> Column:
    """Length of the arc for a squared half chord of the unit sphere."""
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), half_chord_squared)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres between two points given in degrees."""
    rise = F.sin(F.radians(lat2 - lat1) / 2)
    turn = F.sin(F.radians(lon2 - lon1) / 2)
    return arc_km(rise * rise + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * turn * turn)


def longitude_zone(lon: Column) -> dict[str, Column]:
    """0/1 columns west, mid and east; the dividing meridians belong to none."""
    zones = {
        "west": lon < -110,
        "mid": (lon > -110) & (lon < -90),
        "east": lon > -90,
    }
    return {name: F.coalesce(test, F.lit(False)).cast("int") for name, test in zones.items()}
