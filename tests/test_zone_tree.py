"""Points in zones by the quadtree, against plain geometry."""

import math
import random

import pytest
from pyspark.sql import functions as F

from zonepulse.operators import enrich

ZONES = "location_id int, zone string, borough string, ring array<struct<x:double,y:double>>"


def inside(ring, x, y):
    """None on the border, else whether a ray to the right crosses an odd number of edges."""
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        turn = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        if turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return None
        if (y1 > y) != (y2 > y) and (turn > 0) == (y2 > y1):
            odd = not odd
    return odd


def first_zone(zones, x, y):
    return min((i for i, rings in zones.items() if sum(bool(inside(r, x, y)) for r in rings) % 2 and not any(inside(r, x, y) is None for r in rings)), default=None)


@pytest.mark.parametrize("most", [3, 8, 64])
def test_random_polygons(spark, most):
    """Stars with holes that overlap; vertices and points lie on a coarse grid, so that many cases are exact."""
    rnd, zones = random.Random(most), {}
    for i in range(1, 7):
        cx, cy = rnd.randint(-16, 16) / 8, rnd.randint(-16, 16) / 8
        turns = sorted(rnd.random() for _ in range(25))
        star = [(round((cx + r * math.cos(6.2832 * t)) * 64) / 64, round((cy + r * math.sin(6.2832 * t)) * 64) / 64) for t in turns for r in [rnd.uniform(0.4, 1.5)]]
        hole = [(cx - 0.125, cy - 0.125), (cx + 0.125, cy - 0.125), (cx + 0.125, cy + 0.125), (cx - 0.125, cy + 0.125)]
        zones[i] = [star, hole]
    points = [(rnd.randint(-240, 240) / 64, rnd.randint(-240, 240) / 64) for _ in range(1500)] + [p for rings in zones.values() for r in rings for p in r] + [(None, 1.0), (float("nan"), 0.0)]
    table = spark.createDataFrame([(i, f"z{i}", "b", [{"x": x, "y": y} for x, y in r]) for i, rings in zones.items() for r in rings], ZONES)
    frame = spark.createDataFrame([(k, *p) for k, p in enumerate(points)], "k int, x double, y double")
    cells = enrich.zone_cells(table, 1, most)
    got = enrich.assign_zone_by_point(frame, cells, "x", "y", "z", True, 1).collect()
    assert sorted(r.k for r in got) == list(range(len(points)))
    for r in got:
        x, y = points[r.k]
        want = None if x is None or math.isnan(x) else first_zone(zones, x, y)
        assert (r.z, r.z_zone) == (want, want and f"z{want}"), (x, y)


def test_fine_ring(spark):
    """A ring of 100,000 edges inside one cell of the grid: no row holds more than a few of them."""
    n = 100_000
    ring = [{"x": 0.5 + 0.3 * math.cos(2 * math.pi * k / n), "y": 0.5 + 0.3 * math.sin(2 * math.pi * k / n)} for k in range(n)]
    zones = spark.createDataFrame([(7, "round", "b", ring), (9, "square", "b", [{"x": x, "y": y} for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))])], ZONES)
    cells = enrich.zone_cells(zones, 1)
    held = cells.select("level", F.expr("aggregate(transform(candidates, c -> coalesce(size(c.edges), 0)), 0, (a, b) -> a + b)").alias("edges"))
    assert held.agg(F.max("edges")).first()[0] <= enrich.EDGES_PER_CELL < n
    assert held.agg(F.max("level")).first()[0] >= 8
    rnd = random.Random(1)
    points = [(rnd.random(), rnd.random()) for _ in range(2000)] + [(1.5, 0.5)]
    frame = spark.createDataFrame(points, "x double, y double")
    got = enrich.assign_zone_by_point(frame, cells, "x", "y", "z", cells_per_degree=1).collect()
    assert len(got) == len(points)
    for r in got:
        d = math.hypot(r.x - 0.5, r.y - 0.5)
        assert r.z == (None if r.x > 1 else 7 if d < 0.3 - 1e-9 else 9), (r.x, r.y)
