import math
import random

import pytest

from pyspark.sql import functions as F

from triplens.operators import geojoin
from triplens.operators.geojoin import nearby_names, nearest


def distance(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    half = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, half)))


def scattered(seed, count):
    """Points all over, in one crowd, along the date line, and at both poles."""
    rng = random.Random(seed)
    points = []
    for at in range(count):
        kind = at % 4
        if kind == 0:
            points.append((rng.uniform(-90, 90), rng.uniform(-180, 180)))
        elif kind == 1:
            points.append((48.0 + rng.uniform(0, 0.3), 2.0 + rng.uniform(0, 0.3)))
        elif kind == 2:
            points.append((rng.uniform(-20, 20), rng.choice([-1, 1]) * rng.uniform(179, 180)))
        else:
            points.append((rng.choice([-1, 1]) * rng.uniform(88, 90), rng.uniform(-180, 180)))
    points[2] = (0.0, 180.0)
    points[6] = (0.0, -180.0)
    return points


def frames(spark, points, places):
    left = spark.createDataFrame([(str(i), *p) for i, p in enumerate(points)], "key string, lat double, lng double")
    right = spark.createDataFrame(
        [(f"n{i % 23}", *p) for i, p in enumerate(places)], "name string, lat double, lng double")
    return left, right


@pytest.mark.parametrize("radius", [3.0, 60.0, 900.0])
def test_nearest_equals_brute_force(spark, radius):
    points, places = scattered(1, 160), scattered(2, 240)
    left, right = frames(spark, points, places)
    got = {row["key"]: row["name"] for row in nearest(left, right, radius, ["key"], "name").collect()}
    for i, point in enumerate(points):
        near = min(distance(point, place) for place in places)
        name = got[str(i)]
        if name is None:
            assert near > radius
        else:
            # Both names of the date line are one place, so ties go by distance.
            named = min(distance(point, place) for j, place in enumerate(places) if f"n{j % 23}" == name)
            assert named == pytest.approx(near, abs=1e-9) and near <= radius


@pytest.mark.parametrize("radius", [3.0, 60.0, 900.0])
def test_nearby_names_equal_brute_force(spark, radius):
    points, places = scattered(3, 120), scattered(4, 200)
    left, right = frames(spark, points, places)
    rows = nearby_names(left, right, radius, ["key"]).collect()
    expected = {
        (str(i), f"n{j % 23}")
        for i, point in enumerate(points) for j, place in enumerate(places)
        if distance(point, place) <= radius
    }
    assert len(rows) == len(expected)
    assert {tuple(row) for row in rows} == expected


def test_nearest_among_split_cells(spark, monkeypatch):
    """Leaves of three places: the tree is deep, uneven, and has points next to crowds."""
    monkeypatch.setattr(geojoin, "LEAF_PLACES", 3)
    rng = random.Random(6)
    crowd = [(48.1 + rng.gauss(0, s), 2.1 + rng.gauss(0, s)) for s in (1e-1, 1e-3, 1e-5, 1e-7) for _ in range(40)]
    points = scattered(7, 80) + [(a + rng.gauss(0, 1e-6), b) for a, b in crowd[::4]]
    places = scattered(8, 120) + crowd
    left, right = frames(spark, points, places)
    got = {row["key"]: row["name"] for row in nearest(left, right, 60.0, ["key"], "name").collect()}
    for i, point in enumerate(points):
        near = min((distance(point, place), f"n{j % 23}") for j, place in enumerate(places))
        if near[0] > 60.0:
            assert got[str(i)] is None
        else:
            named = min(distance(point, place) for j, place in enumerate(places) if f"n{j % 23}" == got[str(i)])
            assert named == pytest.approx(near[0], abs=1e-9)


def test_crowd_in_a_smallest_cell_is_split(spark):
    """10**5 places within a 512th of the radius: no leaf over the bound, and the nearest is found."""
    count, radius = 100_000, 50.0
    step = radius / geojoin.KM_PER_DEGREE / 512 / 400
    rows = spark.range(count).select(
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("name"),
        (F.lit(48.5) + F.col("id") % 317 * step).alias("lat"), (F.lit(2.5) + F.floor(F.col("id") / 317) * step).alias("lng"),
    )
    levels, leaves, counts = geojoin.cell_tree(rows, radius / geojoin.KM_PER_DEGREE)
    sizes = leaves.groupBy("_level", "_row", "_col").count()
    assert sizes.agg(F.max("count")).first()[0] <= geojoin.LEAF_PLACES
    assert leaves.count() == count == counts[0] and 4 <= len(levels) < geojoin.DEEPEST
    asked = [7, 316, 5_000, 60_123, 99_999]
    points = spark.createDataFrame(
        [(str(i), 48.5 + (i % 317 + 0.3) * step, 2.5 + (i // 317 - 0.2) * step) for i in asked], "key string, lat double, lng double")
    got = {row["key"]: row["name"] for row in nearest(points, rows, radius, ["key"], "name").collect()}
    assert got == {str(i): f"p{i}" for i in asked}


def test_nearest_without_places(spark):
    left, right = frames(spark, scattered(1, 8), [])
    assert [row["name"] for row in nearest(left, right, 60.0, ["key"], "name").collect()] == [None] * 8
