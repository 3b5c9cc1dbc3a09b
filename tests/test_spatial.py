import random

import pytest
from pyspark.sql import functions as F

from caudal.operators import spatial
from caudal.operators.spatial import assign_basin
from caudal.sources.tables import basins_from_rings

RINGS = "basin_ord int, name string, rings array<array<array<double>>>"


def basins(spark, *polygons):
    rows = [(i, name, rings) for i, (name, rings) in enumerate(polygons)]
    return basins_from_rings(spark.createDataFrame(rows, RINGS))


def box(x0, y0, x1, y1):
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


def names(spark, polygons, points, **limits):
    frame = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "i int, lon double, lat double")
    out = assign_basin(frame, polygons, "lon", "lat", "basin", **limits).orderBy("i").collect()
    assert len(out) == len(points)
    return [r.basin for r in out]


def test_boundary_hole_and_concave(spark):
    square = basins(spark, ("s", [box(0.0, 0.0, 2.0, 2.0), box(0.5, 0.5, 1.5, 1.5)]))
    points = [(0, 0), (2, 2), (0, 1), (1, 2), (2, 1), (1, 0), (0.5, 1), (1, 1), (0.25, 1), (1, 0.25), (3, 1), (-1, 0)]
    assert names(spark, square, points) == [None] * 8 + ["s", "s", None, None]
    ell = basins(spark, ("l", [[[0.0, 0.0], [4.0, 0.0], [4.0, 2.0], [2.0, 2.0], [2.0, 4.0], [0.0, 4.0], [0.0, 0.0]]]))
    assert names(spark, ell, [(1, 3), (3, 3), (3, 1), (2, 3), (2, 2), (1, 1)]) == ["l", None, "l", None, None, "l"]


def test_last_match_wins_and_duplicates_stay(spark):
    both = basins(spark, ("first", [box(0.0, 0.0, 3.0, 3.0)]), ("second", [box(1.0, 1.0, 4.0, 4.0)]))
    points = [(2, 2), (2, 2), (0.5, 0.5), (3.5, 3.5), (9, 9)]
    assert names(spark, both, points) == ["second", "second", "first", "second", None]


def test_missing_coordinates(spark):
    one = basins(spark, ("s", [box(0.0, 0.0, 2.0, 2.0)]))
    frame = spark.createDataFrame([(1, None, 1.0), (2, 1.0, 1.0)], "i int, lon double, lat double")
    got = {r.i: r.basin for r in assign_basin(frame, one, "lon", "lat", "basin").collect()}
    assert got == {1: None, 2: "s"}


def brute_force(rings, x, y):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


@pytest.mark.parametrize("limits", [{}, {"most": 2, "deepest": 0, "root": 0.7}, {"most": 1, "deepest": 6, "root": 32.0}])
def test_random_polygons_against_brute_force(spark, limits):
    rng = random.Random(7)
    polygons = []
    for i in range(12):
        cx, cy = rng.uniform(-60, -50), rng.uniform(-35, -25)
        ring = [
            [cx + rng.uniform(0.3, 3) * dx, cy + rng.uniform(0.3, 3) * dy]
            for dx, dy in [(1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1)]
        ]
        polygons.append((f"b{i}", [ring + [ring[0]]]))
    points = [(rng.uniform(-62, -48), rng.uniform(-37, -23)) for _ in range(400)]
    expected = []
    for x, y in points:
        hits = [name for name, rings in polygons if brute_force(rings, x, y)]
        expected.append(hits[-1] if hits else None)
    assert any(expected) and names(spark, basins(spark, *polygons), points, **limits) == expected


def test_points_on_cell_borders_and_edges(spark):
    """Corners and borders of cells are where a ray, an edge and a cell meet."""
    shape = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [2.0, 2.0], [0.0, 4.0], [0.0, 0.0]], [[1.0, 0.5], [1.0, 1.0], [1.5, 1.0], [1.5, 0.5], [1.0, 0.5]]]
    points = [(x / 4, y / 4) for x in range(-2, 19) for y in range(-2, 19)]
    expected = ["s" if brute_force(shape, x, y) else None for x, y in points]
    for limits in ({"root": 1.0, "most": 1, "deepest": 2}, {"root": 32.0, "most": 1, "deepest": 7}):
        assert names(spark, basins(spark, ("s", shape)), points, **limits) == expected


def test_cells_hold_few_edges_and_inner_cells_none(spark):
    """A round basin of 4,000 edges and a comb whose 300 teeth crowd in one place."""
    import math

    ring = [[-50 + 3 * math.cos(i / 2000 * math.pi), -30 + 3 * math.sin(i / 2000 * math.pi)] for i in range(4000)]
    comb = [p for i in range(300) for p in ([-60 + i / 3000, -30.0], [-60 + i / 3000 + 1 / 6000, -30.0 + 0.1])] + [[-59.9, -31.0], [-60.0, -31.0]]
    shapes = {"round": [ring + ring[:1]], "comb": [comb + comb[:1]]}
    polygons = basins(spark, *shapes.items())
    cells = spatial.cover(polygons, most=24, deepest=11, root=4.0).collect()
    assert max(len(c.edges) for c in cells) <= 24
    inner = [c for c in cells if not c.edges]
    assert inner and all(c.odd == 1 for c in inner) and len({c.depth for c in inner}) > 2
    area = sum((4 / 2**c.depth) ** 2 for c in inner if c.name == "round")
    assert 0.8 * 9 * math.pi < area < 9 * math.pi
    assert len(cells) < 6000
    rng = random.Random(3)
    points = [(rng.uniform(-60.05, -59.85), rng.uniform(-30.2, -29.85)) for _ in range(300)] + [(rng.uniform(-53.2, -46.8), rng.uniform(-33.2, -26.8)) for _ in range(100)]
    expected = [next((n for n, rings in shapes.items() if brute_force(rings, x, y)), None) for x, y in points]
    assert len(set(expected)) == 3 and names(spark, polygons, points, most=24, deepest=11, root=4.0) == expected


def test_no_nested_loop(spark):
    one = basins(spark, ("s", [box(0.0, 0.0, 2.0, 2.0)]))
    frame = spark.range(10).select(F.col("id").cast("double").alias("lon"), F.lit(1.0).alias("lat"))
    plan = assign_basin(frame, one, "lon", "lat", "basin")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
