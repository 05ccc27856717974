"""Batch kernels for the hexagon overlay, used inside Arrow UDFs.

Higher-order Column functions evaluate element by element outside generated code, which costs tens
of microseconds per feature and cell. These kernels do the same arithmetic on whole Arrow batches.
They see one batch at a time; partitioning, exploding and aggregation stay with Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from hexloom.functions import projection as P
from hexloom.functions.geometry import RINGS_TYPE
from hexloom.functions.hexgrid import SQRT3, edge

PIECES_TYPE = "array<struct<q:bigint,r:bigint,m:double>>"
BLOCK = 16                 # cells per block side
VERTEX_BUDGET = 1_000_000  # vertices clipped at a time

_PIECE = pa.struct([("q", pa.int64()), ("r", pa.int64()), ("m", pa.float64())])


def _counting(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every whole number of each range lo..hi with the index of its range."""
    n = np.maximum(hi - lo + 1, 0)
    owner = np.repeat(np.arange(len(n)), n)
    return owner, lo[owner] + np.arange(len(owner)) - (np.cumsum(n) - n)[owner]


class _Rings:
    """Flat view of ARRAY<ARRAY<STRUCT<x,y>>>: coordinates, ring limits and row of each ring."""

    def __init__(self, column: pa.Array):
        outer = np.asarray(column.offsets, dtype=np.int64)
        rings = column.values
        limits = np.asarray(rings.offsets, dtype=np.int64)
        points = rings.values
        self.x = points.field(0).to_numpy(zero_copy_only=False)
        self.y = points.field(1).to_numpy(zero_copy_only=False)
        self.rows = len(column)
        self.first_ring, self.end_ring = outer[:-1], outer[1:]
        self.start, self.stop = limits[:-1], limits[1:]

    def by_ring(self) -> tuple[np.ndarray, np.ndarray]:
        return _counting(self.first_ring, self.end_ring - 1)


def _list_of_pieces(rows: int, row: np.ndarray, q, r, m) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])
    values = pa.StructArray.from_arrays(
        [pa.array(q, pa.int64()), pa.array(r, pa.int64()), pa.array(m, pa.float64())],
        fields=list(_PIECE))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _slab(offset, speed, apothem):
    """Parameter range in which offset + t*speed stays within the slab."""
    flat = np.abs(speed) < 1e-12
    safe = np.where(flat, 1.0, speed)
    a, b = (-apothem - offset) / safe, (apothem - offset) / safe
    lo = np.where(flat, np.where(np.abs(offset) > apothem, 2.0, 0.0), np.minimum(a, b))
    return lo, np.where(flat, 1.0, np.maximum(a, b))


def line_batch(column: pa.Array, res: int) -> pa.Array:
    """Length of each line inside every cell it passes, one entry per cell."""
    e = edge(res)
    w, apothem = SQRT3 * e, SQRT3 * e / 2
    g = _Rings(column)
    part_row, part = g.by_ring()
    owner, at = _counting(g.start[part], g.stop[part] - 2)
    row = part_row[owner]
    x0, y0 = g.x[at], g.y[at]
    dx, dy = g.x[at + 1] - x0, g.y[at + 1] - y0

    low, high = np.minimum(y0, y0 + dy), np.maximum(y0, y0 + dy)
    s, r = _counting(np.ceil((low - e) / (1.5 * e)).astype(np.int64),
                     np.floor((high + e) / (1.5 * e)).astype(np.int64))
    level = np.abs(dy[s]) < 1e-9
    rise = np.where(level, 1.0, dy[s])
    ta = np.where(level, 0.0, np.clip((r * 1.5 * e - e - y0[s]) / rise, 0, 1))
    tb = np.where(level, 1.0, np.clip((r * 1.5 * e + e - y0[s]) / rise, 0, 1))
    xa, xb = x0[s] + ta * dx[s], x0[s] + tb * dx[s]
    k, q = _counting(np.ceil(np.minimum(xa, xb) / w - r / 2 - 0.5).astype(np.int64),
                     np.floor(np.maximum(xa, xb) / w - r / 2 + 0.5).astype(np.int64))
    s, r = s[k], r[k]

    cx, cy = (q + r / 2) * w, r * 1.5 * e
    ox, oy, dx, dy = x0[s] - cx, y0[s] - cy, dx[s], dy[s]
    enter, leave = np.zeros(len(q)), np.ones(len(q))
    for a, b in ((1.0, 0.0), (0.5, SQRT3 / 2), (-0.5, SQRT3 / 2)):
        lo, hi = _slab(ox * a + oy * b, dx * a + dy * b, apothem)
        enter, leave = np.maximum(enter, lo), np.minimum(leave, hi)
    m = (leave - enter) * np.sqrt(dx * dx + dy * dy)
    hit = m > 0
    row, q, r, m = row[s[hit]], q[hit], r[hit], m[hit]

    order = np.lexsort((r, q, row))
    row, q, r, m = row[order], q[order], r[order], m[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (q[1:] != q[:-1]) | (r[1:] != r[:-1])
    runs = np.flatnonzero(new)
    total = np.add.reduceat(m, runs) if len(runs) else m
    return _list_of_pieces(g.rows, row[runs], q[runs], r[runs], total)


def _block_pairs(g: _Rings, i: np.ndarray, j: np.ndarray, res: int):
    """(row, q, r) of the cells of each row's block that its bounding box can reach."""
    e = edge(res)
    w = SQRT3 * e
    ring_row, ring = g.by_ring()
    owner, at = _counting(g.start[ring], g.stop[ring] - 1)
    row = ring_row[owner]
    used = np.unique(row)
    limits = np.searchsorted(row, used)
    low = lambda v: np.minimum.reduceat(v[at], limits) if len(used) else np.empty(0)
    high = lambda v: np.maximum.reduceat(v[at], limits) if len(used) else np.empty(0)
    r0 = np.maximum(np.ceil((low(g.y) - e) / (1.5 * e)), j[used] * BLOCK).astype(np.int64)
    r1 = np.minimum(np.floor((high(g.y) + e) / (1.5 * e)), j[used] * BLOCK + BLOCK - 1).astype(np.int64)
    k, r = _counting(r0, r1)
    first = i[used][k] * BLOCK - r // 2
    q0 = np.maximum(np.ceil(low(g.x)[k] / w - r / 2 - 0.5), first).astype(np.int64)
    q1 = np.minimum(np.floor(high(g.x)[k] / w - r / 2 + 0.5), first + BLOCK - 1).astype(np.int64)
    p, q = _counting(q0, q1)
    return used[k[p]], q, r[p]


def _previous(loop: np.ndarray) -> np.ndarray:
    """Index of the vertex before each one, going round its loop."""
    n = len(loop)
    prev = np.arange(-1, n - 1)
    first = np.flatnonzero(np.concatenate([[True], loop[1:] != loop[:-1]]))
    prev[first] = np.concatenate([first[1:] - 1, [n - 1]])
    return prev


def _cut(x, y, loop, a, b, limit):
    """Keep the part of every loop where a*x + b*y <= limit."""
    d = a * x + b * y - limit
    inside = d <= 0
    if inside.all():
        return x, y, loop
    prev = _previous(loop)
    crosses = inside != inside[prev]
    n = crosses.astype(np.int64) + inside
    at = np.cumsum(n) - n
    size = int(n.sum())
    out_x, out_y = np.empty(size), np.empty(size)
    c = np.flatnonzero(crosses)
    pc = prev[c]
    t = d[pc] / (d[pc] - d[c])
    out_x[at[c]], out_y[at[c]] = x[pc] + (x[c] - x[pc]) * t, y[pc] + (y[c] - y[pc]) * t
    k = np.flatnonzero(inside)
    out_x[at[k] + crosses[k]], out_y[at[k] + crosses[k]] = x[k], y[k]
    return out_x, out_y, np.repeat(loop, n)


def _chunks(weight: np.ndarray) -> Iterator[slice]:
    """Consecutive slices whose weights stay near the vertex budget."""
    bins = np.cumsum(weight) // VERTEX_BUDGET
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bins)) + 1, [len(weight)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield slice(int(a), int(b))


def _vertices(g: _Rings, row: np.ndarray):
    """Vertices of all rings of the given rows: coordinates, loop and position in ``row``."""
    pair, ring = _counting(g.first_ring[row], g.end_ring[row] - 1)
    loop, at = _counting(g.start[ring], g.stop[ring] - 1)
    return g.x[at], g.y[at], loop, pair


def _vertex_counts(g: _Rings) -> np.ndarray:
    ring_row, ring = g.by_ring()
    return np.bincount(ring_row, weights=(g.stop - g.start)[ring], minlength=g.rows)


def polygon_batch(column: pa.Array, i: pa.Array, j: pa.Array, res: int) -> pa.Array:
    """Area of each polygon inside every cell of its block."""
    apothem = SQRT3 * edge(res) / 2
    e = edge(res)
    g = _Rings(column)
    row, q, r = _block_pairs(g, i.to_numpy(), j.to_numpy(), res)
    area = np.zeros(len(row))
    for part in _chunks(_vertex_counts(g)[row]):
        x, y, loop, pair = _vertices(g, row[part])
        cx, cy = (q[part] + r[part] / 2) * (SQRT3 * e), r[part] * 1.5 * e
        x, y = x - cx[pair[loop]], y - cy[pair[loop]]
        for k in range(6):
            if len(x):
                x, y, loop = _cut(x, y, loop, np.cos(k * np.pi / 3), np.sin(k * np.pi / 3), apothem)
        if len(x):
            prev = _previous(loop)
            cross = x[prev] * y - x * y[prev]
            area[part] = np.bincount(pair[loop], weights=cross, minlength=part.stop - part.start) / 2
    # coordinates are exact to their last bit only: a border that touches a cell leaves up to this
    reach = np.maximum(np.abs((q + r / 2) * (SQRT3 * e)), np.abs(r * 1.5 * e)) + e
    hit = area > 4 * np.finfo(float).eps * e * reach
    return _list_of_pieces(g.rows, row[hit], q[hit], r[hit], area[hit])


def centre_batch(column: pa.Array, i: pa.Array, j: pa.Array, res: int) -> pa.Array:
    """Cells of each row's block whose centre lies inside the polygon (even-odd rule)."""
    e = edge(res)
    g = _Rings(column)
    row, q, r = _block_pairs(g, i.to_numpy(), j.to_numpy(), res)
    odd = np.zeros(len(row), dtype=bool)
    for part in _chunks(_vertex_counts(g)[row]):
        x, y, loop, pair = _vertices(g, row[part])
        cx, cy = (q[part] + r[part] / 2) * (SQRT3 * e), r[part] * 1.5 * e
        x, y = x - cx[pair[loop]], y - cy[pair[loop]]
        if len(x):
            prev = _previous(loop)
            straddles = (y > 0) != (y[prev] > 0)
            rise = np.where(straddles, y - y[prev], 1.0)
            right = straddles & (0 < x[prev] - y[prev] * (x - x[prev]) / rise)
            odd[part] = np.bincount(pair[loop], weights=right, minlength=part.stop - part.start) % 2 == 1
    return _list_of_pieces(g.rows, row[odd], q[odd], r[odd], np.ones(int(odd.sum())))


def _arrow(run):
    """Marked as not deterministic so that the filter an explode implies is not pushed below it,
    which would run the kernel twice."""
    return F.arrow_udf(run, PIECES_TYPE).asNondeterministic()


def box_batch(column: pa.Array, xmin, ymin, xmax, ymax) -> pa.Array:
    """Rings cut to a box per row; rings that vanish are dropped."""
    g = _Rings(column)
    ring_row, ring = g.by_ring()
    loop, at = _counting(g.start[ring], g.stop[ring] - 1)
    x, y = g.x[at], g.y[at]
    lo_x, lo_y, hi_x, hi_y = (v.to_numpy()[ring_row] for v in (xmin, ymin, xmax, ymax))
    for a, b, limit in ((-1.0, 0.0, -lo_x), (1.0, 0.0, hi_x), (0.0, -1.0, -lo_y), (0.0, 1.0, hi_y)):
        if len(x):
            x, y, loop = _cut(x, y, loop, a, b, limit[loop])
    sizes = np.bincount(loop, minlength=len(ring))
    keep = sizes >= 3
    x, y = x[keep[loop]], y[keep[loop]]
    inner = np.concatenate([[0], np.cumsum(sizes[keep])])
    outer = np.concatenate([[0], np.cumsum(np.bincount(ring_row[keep], minlength=g.rows))])
    points = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])
    rings = pa.ListArray.from_arrays(pa.array(inner, pa.int32()), points)
    return pa.ListArray.from_arrays(pa.array(outer, pa.int32()), rings)


HALVES_TYPE = f"array<struct<i0:bigint,i1:bigint,j0:bigint,j1:bigint,cut:boolean,rings:{RINGS_TYPE}>>"


def halve_batch(column: pa.Array, i0, i1, j0, j1, res: int, most: int) -> pa.Array:
    """Polygons cut into pieces of at most ``most`` blocks each.

    A polygon that reaches more is cut in two along its longer side, the halves again, and so on; a
    piece that vanishes is dropped. Smaller polygons stay whole, as one piece.
    """
    e = edge(res)
    w = SQRT3 * e
    row = np.arange(len(column))
    ranges = np.stack([v.to_numpy(zero_copy_only=False).astype(np.int64) for v in (i0, i1, j0, j1)])
    rings, cut = column, np.zeros(len(column), dtype=bool)
    done = []
    while len(row):
        wide, high = ranges[1] - ranges[0] + 1, ranges[3] - ranges[2] + 1
        large = wide * high > most
        small = np.flatnonzero(~large)
        done.append((row[small], ranges[:, small], cut[small], rings.take(pa.array(small))))
        twice = np.repeat(np.flatnonzero(large), 2)
        row, ranges, across = row[twice], ranges[:, twice], (wide >= high)[twice]
        second = np.arange(len(twice)) % 2 == 1
        for low, way in ((0, across), (2, ~across)):
            middle = (ranges[low] + ranges[low + 1]) // 2
            ranges[low] = np.where(way & second, middle + 1, ranges[low])
            ranges[low + 1] = np.where(way & ~second, middle, ranges[low + 1])
        box = (ranges[0] * BLOCK * w - w / 2, ranges[2] * BLOCK * (1.5 * e) - e,
               (ranges[1] * BLOCK + BLOCK) * w, (ranges[3] * BLOCK + BLOCK - 1) * (1.5 * e) + e)
        rings = box_batch(rings.take(pa.array(twice)), *map(pa.array, box))
        left = np.flatnonzero(np.diff(np.asarray(rings.offsets)) > 0)
        row, ranges, rings, cut = row[left], ranges[:, left], rings.take(pa.array(left)), np.ones(len(left), dtype=bool)
    row = np.concatenate([d[0] for d in done])
    order = np.argsort(row, kind="stable")
    limits = np.concatenate([d[1] for d in done], axis=1)[:, order]
    rings = pa.concat_arrays([d[3] for d in done]).take(pa.array(order))
    pieces = pa.StructArray.from_arrays([*map(pa.array, limits), pa.array(np.concatenate([d[2] for d in done])[order]), rings],
                                        names=["i0", "i1", "j0", "j1", "cut", "rings"])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(column)))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pieces)


def _rebuilt(column: pa.Array, x: np.ndarray, y: np.ndarray) -> pa.Array:
    """The same nesting over new coordinates."""
    points = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])
    rings = pa.ListArray.from_arrays(column.values.offsets, points)
    return pa.ListArray.from_arrays(column.offsets, rings)


def utm_batch(column: pa.Array, zone: int, south: bool) -> pa.Array:
    """Longitude and latitude of every vertex to UTM metres."""
    g = _Rings(column)
    sin_phi = np.sin(np.radians(g.y))
    lam = np.radians(g.x - (zone * 6.0 - 183.0))
    tau = np.sinh(np.arctanh(sin_phi) - P.ECC * np.arctanh(P.ECC * sin_phi))
    xi, eta = np.arctan2(tau, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1.0 + tau * tau))
    north, east = xi.copy(), eta.copy()
    for j, a in enumerate(P.ALPHA, start=1):
        north += a * np.sin(2.0 * j * xi) * np.cosh(2.0 * j * eta)
        east += a * np.cos(2.0 * j * xi) * np.sinh(2.0 * j * eta)
    radius = P.SCALE * P.RECTIFYING
    shift = P.FALSE_NORTHING_SOUTH if south else 0.0
    return _rebuilt(column, P.FALSE_EASTING + radius * east, shift + radius * north)


def _edges(g: _Rings, closed: np.ndarray):
    """Row, start and end of every edge; the closing edge only for closed rows."""
    ring_row, ring = g.by_ring()
    loop, at = _counting(g.start[ring], g.stop[ring] - 1)
    row = ring_row[loop]
    prev = _previous(loop) if len(loop) else loop
    keep = closed[row] | (prev == np.arange(len(loop)) - 1) & (prev >= 0)
    keep &= g.stop[ring][loop] - g.start[ring][loop] > 1
    return row[keep], np.stack([g.x[at][prev[keep]], g.y[at][prev[keep]], g.x[at][keep], g.y[at][keep]])


def _pairs_by_row(a: np.ndarray, b: np.ndarray, rows: int):
    """Index pairs (into a, into b) of entries with the same row; both sorted by row."""
    first = np.searchsorted(b, np.arange(rows))
    end = np.searchsorted(b, np.arange(rows), side="right")
    return _counting(first[a], end[a] - 1)


def _side(e, px, py):
    return (e[2] - e[0]) * (py - e[1]) - (e[3] - e[1]) * (px - e[0])


def _on(e, px, py, side):
    return ((side == 0) & (px >= np.minimum(e[0], e[2])) & (px <= np.maximum(e[0], e[2]))
            & (py >= np.minimum(e[1], e[3])) & (py <= np.maximum(e[1], e[3])))


def _meet(a, b):
    """True where two straight pieces share a point."""
    s1, s2 = _side(a, b[0], b[1]), _side(a, b[2], b[3])
    s3, s4 = _side(b, a[0], a[1]), _side(b, a[2], a[3])
    proper = (np.sign(s1) * np.sign(s2) < 0) & (np.sign(s3) * np.sign(s4) < 0)
    return (proper | _on(a, b[0], b[1], s1) | _on(a, b[2], b[3], s2)
            | _on(b, a[0], a[1], s3) | _on(b, a[2], a[3], s4))


def to_utm_rings(rings: Column, zone: int, south: bool) -> Column:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield utm_batch(batch, zone, south)
    return F.arrow_udf(run, RINGS_TYPE).asNondeterministic()(rings)


def cut_to_box(rings: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for args in batches:
            yield box_batch(*args)
    return F.arrow_udf(run, RINGS_TYPE).asNondeterministic()(rings, xmin, ymin, xmax, ymax)


def halves(rings: Column, ranges: Column, res: int, most: int) -> Column:
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for args in batches:
            yield halve_batch(*args, res, most)
    return F.arrow_udf(run, HALVES_TYPE).asNondeterministic()(
        rings, *[ranges[n] for n in ("i0", "i1", "j0", "j1")])


def line_pieces(parts: Column, res: int) -> Column:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield line_batch(batch, res)
    return _arrow(run)(parts)


def _per_block(kernel, rings: Column, i: Column, j: Column, res: int) -> Column:
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, bi, bj in batches:
            yield kernel(column, bi, bj, res)
    return _arrow(run)(rings, i, j)


def polygon_pieces(rings: Column, i: Column, j: Column, res: int) -> Column:
    return _per_block(polygon_batch, rings, i, j, res)


def covered_cells(rings: Column, i: Column, j: Column, res: int) -> Column:
    return _per_block(centre_batch, rings, i, j, res)
