"""Planar geometry on nested arrays.

A geometry is ``rings ARRAY<ARRAY<STRUCT<x,y>>>`` plus a type tag. Points have one part per
point, lines one part per line. Polygons hold every ring of every member in one flat list with
shells counter-clockwise and holes clockwise, so signed sums need no further structure.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT_TYPE = "struct<x:double,y:double>"
RINGS_TYPE = f"array<array<{POINT_TYPE}>>"

POINT_KINDS = ("Point", "MultiPoint")
LINE_KINDS = ("LineString", "MultiLineString")
POLYGON_KINDS = ("Polygon", "MultiPolygon")


def bind(value: Column, body) -> Column:
    """Compute ``value`` once and pass it to ``body``, inside an expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def last(ring: Column) -> Column:
    return F.get(ring, F.size(ring) - 1)


def square(x: Column, y: Column, side: Column) -> Column:
    """Rings of an axis-parallel square with its lower left corner at x, y."""
    return F.array(F.array(point(x, y), point(x + side, y),
                           point(x + side, y + side), point(x, y + side)))


def bounds(rings: Column) -> Column:
    """STRUCT<xmin,ymin,xmax,ymax> over all vertices; null for an empty geometry."""
    flat = F.flatten(rings)
    xs, ys = flat["x"], flat["y"]
    box = F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                   F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))
    return F.when(F.size(flat) > 0, box)


def finite(rings: Column) -> Column:
    """True when every coordinate of every ring is a finite number."""
    limit = F.lit(float("inf"))
    ok = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit)
    return F.forall(F.flatten(rings), lambda p: ok(p.x) & ok(p.y))


def _moments(ring: Column) -> Column:
    """Twice the signed area and the first moments, relative to the first vertex."""
    o = F.get(ring, F.lit(0))
    end = last(ring)
    zero = F.lit(0.0)
    start = F.struct((end.x - o.x).alias("x"), (end.y - o.y).alias("y"),
                     zero.alias("a"), zero.alias("mx"), zero.alias("my"))

    def step(acc, p):
        return bind(
            F.struct((p.x - o.x).alias("x"), (p.y - o.y).alias("y"),
                     (acc.x * (p.y - o.y) - (p.x - o.x) * acc.y).alias("c")),
            lambda v: F.struct(
                v.x.alias("x"), v.y.alias("y"), (acc.a + v.c).alias("a"),
                (acc.mx + (acc.x + v.x) * v.c).alias("mx"),
                (acc.my + (acc.y + v.y) * v.c).alias("my")))

    return F.aggregate(ring, start, step)


def ring_area(ring: Column) -> Column:
    """Signed area, positive for counter-clockwise rings."""
    o = F.get(ring, F.lit(0))
    end = last(ring)
    start = F.struct((end.x - o.x).alias("x"), (end.y - o.y).alias("y"), F.lit(0.0).alias("a"))
    total = F.aggregate(
        ring, start,
        lambda acc, p: F.struct(
            (p.x - o.x).alias("x"), (p.y - o.y).alias("y"),
            (acc.a + acc.x * (p.y - o.y) - (p.x - o.x) * acc.y).alias("a")),
        lambda acc: acc.a / 2)
    return F.when(F.size(ring) >= 3, total).otherwise(F.lit(0.0))


def area(rings: Column) -> Column:
    """Area of a polygon geometry: holes carry a negative sign already."""
    return F.aggregate(rings, F.lit(0.0), lambda s, ring: s + ring_area(ring))


def centroid(rings: Column) -> Column:
    """Area centroid of a polygon geometry, STRUCT<x,y>."""
    zero = F.lit(0.0)
    start = F.struct(zero.alias("a"), zero.alias("mx"), zero.alias("my"))

    def add(acc, ring):
        o = F.get(ring, F.lit(0))
        return bind(_moments(ring), lambda m: F.struct(
            (acc.a + m.a).alias("a"),
            (acc.mx + m.mx + 3 * o.x * m.a).alias("mx"),
            (acc.my + m.my + 3 * o.y * m.a).alias("my")))

    # Moments are taken around each ring's first vertex, then moved back.
    solid = F.filter(rings, lambda r: F.size(r) >= 3)
    return F.aggregate(solid, start, add,
                       lambda t: point(F.try_divide(t.mx, 3 * t.a), F.try_divide(t.my, 3 * t.a)))


def mean_vertex(rings: Column) -> Column:
    """Mean of all vertices, the centroid of a point set."""
    flat = F.flatten(rings)
    total = F.aggregate(flat, point(F.lit(0.0), F.lit(0.0)),
                        lambda s, p: point(s.x + p.x, s.y + p.y))
    n = F.size(flat)
    return F.when(n > 0, point(total.x / n, total.y / n))


def line_centroid(rings: Column) -> Column:
    """Length-weighted centroid of a line geometry."""
    zero = F.lit(0.0)
    start = F.struct(zero.alias("l"), zero.alias("mx"), zero.alias("my"))

    def add(t, s):
        return bind(F.sqrt((s.x1 - s.x0) * (s.x1 - s.x0) + (s.y1 - s.y0) * (s.y1 - s.y0)),
                    lambda d: F.struct((t.l + d).alias("l"),
                                       (t.mx + d * (s.x0 + s.x1) / 2).alias("mx"),
                                       (t.my + d * (s.y0 + s.y1) / 2).alias("my")))

    return F.aggregate(segments(rings), start, add,
                       lambda t: point(F.try_divide(t.mx, t.l), F.try_divide(t.my, t.l)))


def any_centroid(rings: Column, kind: Column) -> Column:
    """Centroid by geometry type."""
    return (F.when(kind.isin(*POLYGON_KINDS), centroid(rings))
             .when(kind.isin(*LINE_KINDS), line_centroid(rings))
             .otherwise(mean_vertex(rings)))


def segments(parts: Column) -> Column:
    """All straight pieces of a line geometry, ARRAY<STRUCT<x0,y0,x1,y1>>."""
    def of(part):
        return F.zip_with(
            F.slice(part, 1, F.greatest(F.size(part) - 1, F.lit(0))),
            F.slice(part, 2, F.greatest(F.size(part) - 1, F.lit(0))),
            lambda a, b: F.struct(a.x.alias("x0"), a.y.alias("y0"),
                                  b.x.alias("x1"), b.y.alias("y1")))
    return F.flatten(F.transform(parts, of))


def length(parts: Column) -> Column:
    return F.aggregate(segments(parts), F.lit(0.0), lambda s, e: s + F.sqrt(
        (e.x1 - e.x0) * (e.x1 - e.x0) + (e.y1 - e.y0) * (e.y1 - e.y0)))


def repair(rings: Column) -> Column:
    """Drop repeated vertices and the closing copy, then rings with fewer than three left."""
    def tidy(ring):
        distinct = F.filter(ring, lambda p, i: (i == 0) | ~bind(
            F.get(ring, i - 1), lambda q: (q.x == p.x) & (q.y == p.y)))
        head, tail = F.get(distinct, F.lit(0)), last(distinct)
        closed = (F.size(distinct) > 1) & (head.x == tail.x) & (head.y == tail.y)
        return F.when(closed, F.slice(distinct, 1, F.size(distinct) - 1)).otherwise(distinct)
    return F.filter(F.transform(rings, tidy), lambda r: F.size(r) >= 3)


def is_repairable(rings: Column) -> Column:
    """True when all coordinates are finite and repair leaves at least one ring."""
    return F.coalesce(finite(rings) & (F.size(repair(rings)) > 0), F.lit(False))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = (F.pow(F.sin(dlat / 2), 2.0)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2.0))
    return 2 * 6371.0088 * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def overlaps_box(box: Column, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Inclusive overlap of a bbox struct column, in a form the Parquet reader can use."""
    return ((box["xmin"] <= xmax) & (box["xmax"] >= xmin)
            & (box["ymin"] <= ymax) & (box["ymax"] >= ymin))


def in_box(x: Column, y: Column, box: tuple[float, float, float, float]) -> Column:
    """Inclusive on all four sides; ``box`` is (xmin, ymin, xmax, ymax)."""
    return x.between(box[0], box[2]) & y.between(box[1], box[3])
