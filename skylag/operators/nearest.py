"""Nearest neighbour on the globe, without forming the pairs of both tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_KM, LOWER_48, Box, haversine_km
from ..sources.tables import BROADCAST_ROWS, materialize

# Cell sizes in degrees; all are powers of two, so that cells nest exactly. The finest is
# finer than the seventh decimal of a degree.
CELL_DEGREES = tuple(8.0 / 8**level for level in range(10))

# A cell with more places than this is divided.
PLACES_IN_A_CELL = 16

# Distances that agree to the millimetre are ties; pruning leaves room for them.
_TIE_DIGITS = 6
_SLACK_KM = 2e-6

# Left points for which one salt of the joins on cells is meant.
_POINTS_A_SALT = 50_000


def _inside(df: DataFrame, id_col: str, lat: str, lon: str, box: Box) -> DataFrame:
    chosen = df.selectExpr(f"{id_col} AS id", f"{lat} AS lat", f"{lon} AS lon")
    return chosen.filter(box.holds(F.col("lat"), F.col("lon")))


def points(df: DataFrame, id_col: str, lat: str, lon: str, box: Box) -> DataFrame:
    """Distinct points (id, lat, lon) inside the box."""
    return _inside(df, id_col, lat, lon, box).distinct()


def _cell(size: float, lat: str = "lat", lon: str = "lon") -> tuple[str, str]:
    """Row and column of the grid cell of a point, as SQL."""
    return (
        f"CAST(floor(({lat} + 90) / {size}D) AS LONG) AS r",
        f"CAST(floor(({lon} + 180) / {size}D) AS LONG) AS c",
    )


def _span(size: float) -> tuple[str, str]:
    """Bounds in km for the distance from (lat, lon) to any point of cell (r, c), as SQL.

    Rise and turn are bounded one by one, and so is the cosine of the other
    latitude; the haversine grows with each of the three.
    """
    south, north = f"(r * {size}D - 90)", f"(r * {size}D + {size}D - 90)"
    ahead = f"pmod(lon + 180 - c * {size}D, 360D)"
    behind = f"pmod(c * {size}D + {size}D - 180 - lon, 360D)"
    edges = f"least({ahead}, 360 - {ahead}), least({behind}, 360 - {behind})"
    cosines = f"cos(radians({south})), cos(radians({north}))"

    def km(rise: str, turn: str, width: str) -> str:
        half_chord = (
            f"power(sin(radians({rise}) / 2), 2)"
            f" + cos(radians(lat)) * {width} * power(sin(radians({turn}) / 2), 2)"
        )
        return f"2 * {EARTH_RADIUS_KM} * asin(sqrt(least(1D, {half_chord})))"

    near = km(
        f"greatest(0D, {south} - lat, lat - {north})",
        f"if({ahead} <= {size}D, 0D, least({edges}))",
        f"greatest(0D, least({cosines}))",
    )
    far = km(
        f"greatest(abs(lat - {south}), abs(lat - {north}))",
        f"if(pmod({ahead} + 180, 360D) <= {size}D, 180D, greatest({edges}))",
        f"if({south} <= 0 AND {north} >= 0, 1D, greatest({cosines}))",
    )
    return near, far


def _keep_reachable(cells: DataFrame) -> DataFrame:
    """Drop the cells that lie farther than some other cell of the same point.

    Every cell holds a point, so the smallest far bound is a distance that the
    nearest neighbour cannot exceed.
    """
    reach = "min(far) OVER (PARTITION BY id, lat, lon)"
    return (
        cells.selectExpr("*", f"{reach} AS reach")
        .filter(f"near <= reach + {_SLACK_KM}D")
        .drop("reach")
    )


def cell_tree(
    places: DataFrame, cell_degrees: tuple[float, ...] = CELL_DEGREES, most: int = PLACES_IN_A_CELL
) -> DataFrame:
    """The cells (level, r, c, n, open) that are looked into for places (lat, lon).

    A cell with more than ``most`` places is open: the cells of the next level inside it
    are in the tree too. All levels are counted in one grouping; whether the cell around is
    open follows from the sum over its few parts, so no level waits for the one before it.
    """
    levels = [
        F.struct(F.lit(level).alias("level"), *[F.expr(e) for e in _cell(size)])
        for level, size in enumerate(cell_degrees)
    ]
    counted = (
        places.select(F.inline(F.array(*levels)))
        .groupBy("level", "r", "c")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ratios = [1, *(int(o / i) for o, i in zip(cell_degrees, cell_degrees[1:], strict=False))]
    ratio = f"element_at(array({', '.join(f'{r}L' for r in ratios)}), level + 1)"
    return (
        counted.selectExpr("*", f"r DIV {ratio} AS outer_r", f"c DIV {ratio} AS outer_c")
        .selectExpr("*", "sum(n) OVER (PARTITION BY level, outer_r, outer_c) AS around")
        .filter((F.col("level") == 0) | (F.col("around") > most))
        .withColumn("open", (F.col("n") > most) & (F.col("level") < len(cell_degrees) - 1))
        .drop("around")
    )


def _salts(left: DataFrame, size: float) -> int:
    """Salts for the joins on cells, by the most left points that share a cell of a size."""
    cells = left.selectExpr(*_cell(size)).groupBy("r", "c").count()
    return -(-(cells.agg(F.max("count")).first()[0] or 0) // _POINTS_A_SALT) or 1


def measured_pairs(
    left: DataFrame,
    right: DataFrame,
    box: Box = LOWER_48,
    left_cols: tuple[str, str, str] = ("airport_id", "lat", "lon"),
    right_cols: tuple[str, str, str] = ("station_id", "lat", "lon"),
    cell_degrees: tuple[float, ...] = CELL_DEGREES,
) -> DataFrame:
    """Left points (id, lat, lon) with the few right places that may be their nearest, and how
    far off these are: the search that ``nearest_join`` describes."""
    spots = _inside(right, *right_cols, box).groupBy("lat", "lon").agg(F.min("id").alias("station_id"))
    places = materialize(spots, "places")
    tree = materialize(cell_tree(places, cell_degrees), "cell-tree")
    cells_in_all, deepest = tree.agg(
        F.count(F.lit(1)), F.max(F.when(F.col("open"), F.col("level")))
    ).first()
    deepest = -1 if deepest is None else deepest

    points_in = points(left, *left_cols, box)
    # Each place is in one closed cell of the tree at least, so it has no more places than cells
    # times what a cell holds; both are small if the larger is.
    small = max(cells_in_all, places.limit(BROADCAST_ROWS + 1).count()) <= BROADCAST_ROWS
    salts = 1 if small else _salts(points_in, cell_degrees[min(1, len(cell_degrees) - 1)])

    def met(cells: DataFrame) -> DataFrame:
        """The right side of a join on cells."""
        if small:
            return F.broadcast(cells.withColumn("salt", F.lit(0)))
        return cells.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    top = cell_degrees[0]

    def across(low: float, high: float, edge: int) -> Column:
        first = math.floor((max(low, -edge) + edge) / top)
        last = math.floor((min(high, edge) + edge) / top)
        return F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long")))

    salt = f"CAST(pmod(xxhash64(id, lat, lon), {salts}) AS INT) AS salt"
    near, far = _span(top)
    cells = (
        points_in.selectExpr("*", salt, "0 AS level")
        .withColumn("r", across(box.south, box.north, 90))
        .withColumn("c", across(box.west, box.east, 180))
        .join(met(tree.filter("level = 0").select("r", "c")), ["r", "c", "salt"])
        .selectExpr("*", f"{near} AS near", f"{far} AS far")
    )
    cells = _keep_reachable(cells)
    for level in range(deepest + 1):
        # Divided cells are replaced by those inside them; the others match nothing and stay.
        parts = tree.filter(F.col("level") == level + 1).selectExpr(
            f"{level} AS level", "outer_r AS r", "outer_c AS c", "r AS in_r", "c AS in_c"
        )
        near, far = _span(cell_degrees[level + 1])
        cells = (
            cells.join(met(parts), ["level", "r", "c", "salt"], "left")
            .selectExpr(
                "id", "lat", "lon", "salt", "near AS near_before", "far AS far_before",
                "in_r IS NOT NULL AS deeper",
                f"if(in_r IS NULL, level, {level + 1}) AS level",
                "coalesce(in_r, r) AS r", "coalesce(in_c, c) AS c",
            )
            .selectExpr(
                "id", "lat", "lon", "salt", "level", "r", "c",
                f"if(deeper, {near}, near_before) AS near", f"if(deeper, {far}, far_before) AS far",
            )
        )
        cells = _keep_reachable(cells)

    levels = [
        F.struct(F.lit(level).alias("level"), *[F.expr(e) for e in _cell(size)])
        for level, size in enumerate(cell_degrees[: deepest + 2])
    ]
    lowest = tree.filter(~F.col("open")).select("level", "r", "c")
    held = places.select("*", F.inline(F.array(*levels))).join(
        F.broadcast(lowest) if small else lowest, ["level", "r", "c"]
    )
    held = met(
        held.select(
            "level", "r", "c", "station_id",
            F.col("lat").alias("station_lat"), F.col("lon").alias("station_lon"),
        )
    )
    distance = haversine_km(
        F.col("station_lat"), F.col("station_lon"), F.col("lat"), F.col("lon")
    )
    return cells.join(held, ["level", "r", "c", "salt"]).withColumn("haversine", distance)


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    box: Box = LOWER_48,
    left_cols: tuple[str, str, str] = ("airport_id", "lat", "lon"),
    right_cols: tuple[str, str, str] = ("station_id", "lat", "lon"),
    cell_degrees: tuple[float, ...] = CELL_DEGREES,
) -> DataFrame:
    """For each left id its nearest right id, both inside the box.

    A search down a tree of grid cells that is as deep as the right points are dense: only
    cells with many places are divided, so a town with thousands of them is cut into small
    cells, and an empty region stays one cell. Each left point starts with the
    coarse cells of the box, keeps those that can still hold its nearest neighbour, and goes
    on to the cells inside the divided ones; distances to single places are only taken in
    cells that are not divided, which hold few. Every step is an equi-join on cell numbers,
    so the work grows with left points times a few cells, not with left times right. Right
    points at one place count once, by their smallest id, which is also the one that wins a
    tie.

    The tree and its places are written. Where a count shows them to be small they are
    broadcast, and left points are shuffled once; else the joins shuffle, and left points
    that crowd in one cell are spread over as many salts as a count of them asks for.

    Gives ``airport_id, station_id, haversine, airport_lat, airport_lon``.
    """
    measured = measured_pairs(left, right, box, left_cols, right_cols, cell_degrees)
    closest_first = (
        f"row_number() OVER (PARTITION BY id"
        f" ORDER BY round(haversine, {_TIE_DIGITS}), station_id, lat, lon) AS row_num"
    )
    return (
        measured.selectExpr("*", closest_first)
        .filter("row_num = 1")
        .selectExpr(
            "id AS airport_id",
            "station_id",
            "haversine",
            "lat AS airport_lat",
            "lon AS airport_lon",
        )
    )


def pair_counts(left: DataFrame, right: DataFrame, box: Box = LOWER_48) -> DataFrame:
    """How many pairs of both tables there would be, before and after the box.

    Counted from the two sides; the pairs themselves are never formed.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        inside = F.coalesce(box.holds(F.col("lat"), F.col("lon")), F.lit(False))
        return df.distinct().agg(
            F.count(F.lit(1)).alias(f"{name}_all"), F.count_if(inside).alias(f"{name}_boxed")
        )

    both = side(left, "left").withColumn("one", F.lit(1)).join(
        side(right, "right").withColumn("one", F.lit(1)), "one"
    )
    return both.select(
        (F.col("left_all") * F.col("right_all")).alias("pairs_all"),
        (F.col("left_boxed") * F.col("right_boxed")).alias("pairs_boxed"),
    )
