"""The boundary filter by edge grid: slits, holes, parts, tile borders, large outlines."""

import random
import resource

import numpy as np
import pyarrow as pa
import pytest

from hexloom.functions.edge_grid import EdgeGrid, Frame
from hexloom.operators import spatial as SP

RINGS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
#: A square with a slit from above, a square hole, and a second part to the right.
SLIT = [[(0, 0), (64, 0), (64, 64), (30.75, 64), (30.75, 16), (30.25, 16), (30.25, 64), (0, 64)],
        [(8, 8), (8, 12), (12, 12), (12, 8)], [(80, 0), (90, 0), (90, 10), (80, 10)]]
#: The same closed set as rectangles.
BOXES = [(0, 0, 64, 8), (0, 12, 64, 16), (0, 8, 8, 12), (12, 8, 64, 12), (0, 16, 30.25, 64), (30.75, 16, 64, 64), (80, 0, 90, 10)]


def column(*geometries):
    return pa.array([[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in g] for g in geometries], RINGS)


def frame(spark, items):
    return spark.createDataFrame(
        [(i, kind, [[(float(x), float(y)) for x, y in ring] for ring in g]) for i, (kind, g) in enumerate(items)],
        "feature_id int, geom_type string, rings array<array<struct<x:double,y:double>>>")


def square(x, y, s):
    return "Polygon", [[(x, y), (x + s, y), (x + s, y + s), (x, y + s)]]


def in_boxes(x0, y0, x1, y1):
    return any(x0 <= b[2] and x1 >= b[0] and y0 <= b[3] and y1 >= b[1] for b in BOXES)


@pytest.mark.parametrize("limit", [10 ** 6, 0])
def test_slit_hole_and_parts(spark, monkeypatch, limit):
    monkeypatch.setattr(SP, "BROADCAST_VERTICES", limit)
    rng = random.Random(5)
    items = [("Point", [[(30.5, 20)]]), ("Point", [[(30.5, 40)]]), ("Point", [[(30.5, 16)]]), ("Point", [[(30.25, 40)]]),
             ("Point", [[(10, 10)]]), ("Point", [[(8, 10)]]), ("Point", [[(85, 5)]]), ("Point", [[(70, 5)]]),
             square(9, 9, 1), square(8, 8, 4), square(-100, -100, 400), square(85, -50, 2), square(30.4, 30, 0.2),
             square(70, -5, 5), square(79, -1, 12), ("LineString", [[(30.5, 70), (30.5, 17)]]), ("LineString", [[(30.5, 70), (30.5, 16)]]),
             ("LineString", [[(64, 70), (70, 64)], [(9, 9), (11, 11)]]), ("LineString", [[(-5, 40), (100, 40)]]),
             ("MultiPoint", [[(10, 10)], [(200, 200)]]), ("MultiPoint", [[(10, 10)], [(81, 1)]]), ("Point", [])]
    want = {2, 3, 5, 6, 9, 10, 14, 16, 18, 20}
    side = Frame(0, 0, 90, 64, 16).side
    for k in range(150):
        x, y = rng.choice([(rng.randint(-4, 100), rng.randint(-4, 70)), (k % 17 * side - 0.9, k // 17 * side - 0.9)])
        s = rng.choice([0, 1, 5, 40])
        want |= {len(items)} if in_boxes(x, y, x + s, y + s) else set()
        items.append(square(x, y, s) if s else ("Point", [[(x, y)]]))
    got = SP.filter_intersecting(frame(spark, items), frame(spark, [("Polygon", SLIT)]).select("rings"))
    assert {r.feature_id for r in got.collect()} == want


def star(n, seed, r=1000.0):
    rng = np.random.default_rng(seed)
    angle = np.sort(rng.uniform(0, 2 * np.pi, n))
    radius = r * rng.uniform(0.4, 1.0, n)
    return list(zip(radius * np.cos(angle), radius * np.sin(angle)))


def ray_inside(ring, x, y):
    p = np.array(ring)
    q = np.roll(p, 1, axis=0)
    cut = (p[:, 1] > y) != (q[:, 1] > y)
    at = p[cut, 0] + (y - p[cut, 1]) * (q[cut, 0] - p[cut, 0]) / (q[cut, 1] - p[cut, 1])
    return (at > x).sum() % 2 == 1


def test_points_of_a_jagged_outline():
    ring = star(5000, 1)
    grid = EdgeGrid(column([ring]))
    rng = np.random.default_rng(2)
    x, y = rng.uniform(-1100, 1100, (2, 3000))
    assert grid.holds(x, y).tolist() == [ray_inside(ring, a, b) for a, b in zip(x, y)]
    vertex = np.array(ring)
    assert grid.holds(vertex[:, 0], vertex[:, 1]).all()


def test_two_outlines_of_20000_vertices_in_bounded_memory():
    grid = EdgeGrid(column([star(20_000, 3)]))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    far = [(x + 5000, y) for x, y in star(20_000, 4)]
    around = [(3 * x, 3 * y) for x, y in star(20_000, 5)]
    inner = [(x / 4, y / 4) for x, y in star(20_000, 6)]
    kinds = pa.array(["Polygon"] * 4)
    got = grid.meets(column([star(20_000, 4)], [far], [around], [inner]), kinds)
    assert got.tolist() == [True, False, True, True]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600_000  # kB
