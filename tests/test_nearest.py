"""The cell search against all pairs, on small random and awkward inputs."""

import math
import random

import pytest

from skylag.functions.geo import LOWER_48, WORLD
from skylag.operators import nearest
from skylag.operators.nearest import cell_tree, nearest_join


def km(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = (
        math.sin((lat2 - lat1) / 2) ** 2
        + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    )
    return 2 * 6371 * math.asin(math.sqrt(min(1.0, h)))


def brute(airports, stations, box):
    def inside(p):
        return box.south < p[1] < box.north and box.west < p[2] < box.east

    best = {}
    for a in filter(inside, airports):
        for s in filter(inside, stations):
            found = (round(km(a[1:], s[1:]), 6), s[0])
            best[a[0]] = min(best.get(a[0], found), found)
    return best


def check(spark, airports, stations, box, **options):
    left = spark.createDataFrame(airports, "airport_id int, lat double, lon double")
    right = spark.createDataFrame(stations, "station_id int, lat double, lon double")
    rows = nearest_join(left, right, box, **options).collect()
    got = {r.airport_id: (round(r.haversine, 6), r.station_id) for r in rows}
    assert len(rows) == len(got)
    want = brute(airports, stations, box)
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    assert all(got[k][0] == pytest.approx(want[k][0], abs=2e-6) for k in want)


def scatter(seed, n, lat, lon, digits=3):
    draw = random.Random(seed)
    return [(i, round(draw.uniform(*lat), digits), round(draw.uniform(*lon), digits)) for i in range(n)]


def test_random_points(spark):
    check(spark, scatter(1, 60, (20, 55), (-130, -55)), scatter(2, 300, (20, 55), (-130, -55)), LOWER_48)


def test_whole_globe_with_poles_and_date_line(spark):
    airports = scatter(3, 40, (-90, 90), (-180, 180)) + [
        (100, 89.9, 10.0), (101, -89.9, 170.0), (102, 0.0, 179.9), (103, 0.0, -179.9), (104, 0.0, 180.0),
        (105, 90.0, 0.0), (106, -90.0, 0.0),
    ]
    check(spark, airports, scatter(4, 60, (-90, 90), (-180, 180)), WORLD)


def test_most_stations_in_one_town(spark):
    crowd = scatter(5, 300, (40.0, 40.02), (-100.02, -100.0))
    far = [(1000 + i, lat, lon) for i, lat, lon in scatter(6, 10, (25, 49), (-126, -61))]
    check(spark, scatter(7, 40, (39, 41), (-101, -99)), crowd + far, LOWER_48)


def test_few_stations_far_away(spark):
    check(spark, scatter(8, 30, (25, 49), (-126, -61)), [(1, 25.0, -61.0), (2, 49.0, -126.0)], LOWER_48)


def test_tie_and_repeats_take_the_smallest_id(spark):
    stations = [(9, 40.0, -99.0), (5, 40.0, -101.0), (7, 40.0, -101.0), (9, 40.0, -99.0)]
    check(spark, [(1, 40.0, -100.0), (1, 40.0, -100.0)], stations, LOWER_48)


def test_numbers_not_texts_are_compared(spark):
    # About 100, 25 and 9.5 km north: as text the longest would come first.
    stations = [(1, 40.9, -100.0), (2, 40.2275, -100.0), (3, 40.0855, -100.0)]
    check(spark, [(1, 40.0, -100.0)], stations, LOWER_48)


def test_one_airport_id_at_two_places(spark):
    check(spark, [(1, 40.0, -100.0), (1, 30.0, -90.0)], [(1, 41.0, -100.0), (2, 30.1, -90.0)], LOWER_48)


def test_box_edge_and_missing_points_are_out(spark):
    stations = [(1, 24.45, -100.0), (2, None, -100.0), (3, 30.0, None), (4, 45.0, -100.0)]
    left = spark.createDataFrame([(1, 25.0, -100.0), (2, 49.46, -100.0)], "airport_id int, lat double, lon double")
    right = spark.createDataFrame(stations, "station_id int, lat double, lon double")
    rows = nearest_join(left, right, LOWER_48).collect()
    assert [(r.airport_id, r.station_id) for r in rows] == [(1, 4)]


def test_any_nesting_grid_gives_the_same(spark):
    airports, stations = scatter(10, 30, (25, 49), (-126, -61)), scatter(11, 200, (25, 49), (-126, -61))
    for grid in [(4.0,), (16.0, 1.0), (8.0, 1.0, 0.125, 0.015625)]:
        check(spark, airports, stations, LOWER_48, cell_degrees=grid)


def test_dense_points_to_seven_decimals(spark):
    town = ((40.0, 40.0001), (-100.0001, -100.0))
    check(spark, scatter(12, 60, *town, digits=7), scatter(13, 900, *town, digits=7), LOWER_48)


def test_places_on_the_finest_grid_and_at_equal_coordinates(spark):
    line = [(i, 40.0 + (i % 40) * 1e-7, -100.0) for i in range(400)]
    check(spark, [(1, 40.0, -100.0), (2, 40.0000021, -100.0), (3, 45.0, -90.0)], line, LOWER_48)


@pytest.mark.parametrize("rows_at_most", [0, 10**6])
def test_salted_and_broadcast_joins_agree(spark, monkeypatch, rows_at_most):
    monkeypatch.setattr(nearest, "BROADCAST_ROWS", rows_at_most)
    monkeypatch.setattr(nearest, "_POINTS_A_SALT", 7)
    airports, stations = scatter(14, 50, (40, 41), (-101, -100)), scatter(15, 400, (40, 41), (-101, -100))
    check(spark, airports, stations, LOWER_48)


def test_only_crowded_cells_are_divided(spark):
    crowd = scatter(16, 500, (40.0, 40.01), (-100.01, -100.0), digits=5)
    far = [(1000, 25.0, -70.0), (1001, 48.0, -120.0)]
    places = spark.createDataFrame(crowd + far, "id int, lat double, lon double").dropDuplicates(["lat", "lon"])
    tree = cell_tree(places).collect()
    by_level = {}
    for cell in tree:
        by_level.setdefault(cell.level, []).append(cell)
    assert sum(c.n for c in tree if not c.open) == places.count()
    assert all(c.n <= nearest.PLACES_IN_A_CELL for c in tree if not c.open)
    assert len(by_level[0]) == 3 and max(by_level) <= 5
    assert sum(len(cells) for cells in by_level.values()) < 500


def distances_taken(spark, points, places):
    """Rows of the last join of the search, in a square of some 300 metres."""
    town = ((40.0, 40.0035), (-100.0035, -100.0))
    left = spark.createDataFrame(scatter(17, points, *town, digits=7), "airport_id int, lat double, lon double")
    right = spark.createDataFrame(scatter(18, places, *town, digits=7), "station_id int, lat double, lon double")
    measured = nearest.measured_pairs(left, right)
    rows = measured.groupBy("id").count().collect()
    assert len(rows) == points
    return sum(r["count"] for r in rows)


def test_crowded_square_grows_with_the_points_not_with_the_pairs(spark):
    """Each point is held against some places, however many there are: 16 and 64 million pairs."""
    some, more = distances_taken(spark, 2000, 8000), distances_taken(spark, 4000, 16000)
    assert some < 2000 * 60 and more < 4000 * 60


def test_crowded_square_equals_brute_force(spark):
    town = ((40.0, 40.0035), (-100.0035, -100.0))
    check(spark, scatter(19, 150, *town, digits=7), scatter(20, 8000, *town, digits=7), LOWER_48)
