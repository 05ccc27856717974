"""A polygon's own edges on a grid of tiles, with one inside/outside answer for each tile.

Edges are registered with every tile they pass and are never cut, so nothing is found on a border that
the polygon doesn't have. Each tile has a point off all edges whose answer comes from the crossings of
a ray; any other point of the tile differs from it by the tile's edges between the two. A feature is
compared with the edges of the tiles that its own edges pass, and with the answers of one vertex for
each of its parts: without a common point, a part lies inside or outside as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from hexloom.functions.kernels import _chunks, _counting, _edges, _meet, _on, _pairs_by_row, _Rings, _side

#: Tiles per side, by the root of the number of edges within these limits.
TILES = (16, 256)
#: Part of a tile's side by which an edge's tiles reach too far, which covers rounding.
PAD = 1e-4
SOLID = ("Polygon", "MultiPolygon")


class Frame:
    """A square of tiles x tiles that surrounds a box; points on the box's border lie inside it."""

    def __init__(self, xmin: float, ymin: float, xmax: float, ymax: float, edges: int):
        self.n = int(min(max(np.ceil(np.sqrt(edges)), TILES[0]), TILES[1]))
        extent = max(xmax - xmin, ymax - ymin, 1e-9)
        self.side = extent * 1.02 / self.n
        self.x, self.y = xmin - extent * 0.01, ymin - extent * 0.01

    def tiles_of(self, px: np.ndarray, py: np.ndarray) -> np.ndarray:
        """Tile of each point, -1 outside."""
        i, j = (np.floor((p - o) / self.side) for p, o in ((px, self.x), (py, self.y)))
        good = (i >= 0) & (i < self.n) & (j >= 0) & (j < self.n)
        return np.where(good, j * self.n + i, -1).astype(np.int64)

    def passed(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edge, tile) of every tile that an edge passes."""
        side, n = self.side, self.n
        x0, y0, x1, y1 = e[0] - self.x, e[1] - self.y, e[2] - self.x, e[3] - self.y
        clip = lambda v: np.clip(np.floor(v / side), -1, n).astype(np.int64)
        k, j = _counting(np.maximum(clip(np.minimum(y0, y1) - PAD * side), 0),
                         np.minimum(clip(np.maximum(y0, y1) + PAD * side), n - 1))
        rise, run = (y1 - y0)[k], (x1 - x0)[k]
        level = np.abs(rise) < 1e-6 * side
        safe = np.where(level, 1.0, rise)
        a = np.where(level, 0.0, np.clip((j * side - y0[k]) / safe, 0, 1))
        b = np.where(level, 1.0, np.clip(((j + 1) * side - y0[k]) / safe, 0, 1))
        xa, xb = x0[k] + a * run, x0[k] + b * run
        m, i = _counting(np.maximum(clip(np.minimum(xa, xb) - PAD * side), 0),
                         np.minimum(clip(np.maximum(xa, xb) + PAD * side), n - 1))
        return k[m], j[m] * n + i


def _answers(frame: Frame, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each tile a point off all edges, and whether it lies inside (even-odd rule)."""
    n, side = frame.n, frame.side
    rx, ry, inside = np.empty((n, n)), np.empty((n, n)), np.empty((n, n), dtype=bool)
    low, high = np.minimum(e[1], e[3]), np.maximum(e[1], e[3])
    for j in range(n):
        own = e[:, (high >= frame.y + j * side) & (low <= frame.y + (j + 1) * side)]
        share = 0.5
        while True:
            y = frame.y + (j + share) * side
            x = frame.x + (np.arange(n) + share) * side
            off = 1e-9 * side
            cut = own[:, (own[1] > y) != (own[3] > y)]
            at = np.sort(cut[0] + (y - cut[1]) * (cut[2] - cut[0]) / (cut[3] - cut[1]))
            close = np.searchsorted(at, x - off) != np.searchsorted(at, x + off, side="right")
            if not close.any() and not (np.abs(own[1] - y) <= off).any() and not (np.abs(own[3] - y) <= off).any():
                break
            share = (share + 0.6180339887498949) % 0.98 + 0.01
        rx[j], ry[j], inside[j] = x, y, (len(at) - np.searchsorted(at, x)) % 2 == 1
    return rx.ravel(), ry.ravel(), inside.ravel()


def _between(e: np.ndarray, rx, ry, px, py) -> np.ndarray:
    """True for edges that part the point r, which is on none of them, from p."""
    parted = (_side(e, rx, ry) > 0) != (_side(e, px, py) > 0)
    line = np.stack(np.broadcast_arrays(rx, ry, px, py))
    return parted & ((_side(line, e[0], e[1]) > 0) != (_side(line, e[2], e[3]) > 0))


def _first_vertices(g: _Rings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, x and y of the first vertex of every ring that has one."""
    row, ring = g.by_ring()
    some = g.stop[ring] > g.start[ring]
    at = g.start[ring[some]]
    return row[some], g.x[at], g.y[at]


def _is_solid(kinds: pa.Array) -> np.ndarray:
    return np.isin(np.asarray(kinds.to_pylist(), dtype=object), SOLID)


class EdgeGrid:
    """The grid of one polygon, given as an array of one row of rings."""

    def __init__(self, polygon: pa.Array, frame: Frame | None = None):
        g = _Rings(polygon)
        _, self.e = _edges(g, np.ones(1, dtype=bool))
        _, self.px, self.py = _first_vertices(g)
        if frame is None:
            frame = Frame(g.x.min(), g.y.min(), g.x.max(), g.y.max(), self.e.shape[1])
        self.frame = frame
        edge, tile = frame.passed(self.e)
        self.edge = edge[np.argsort(tile, kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(tile, minlength=frame.n ** 2))])
        self.rx, self.ry, self.inside = _answers(frame, self.e)

    def _candidates(self, tile: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``tile``, edge) of every edge of each tile."""
        k, at = _counting(self.first[tile], self.first[tile + 1] - 1)
        return k, self.edge[at]

    def holds(self, px: np.ndarray, py: np.ndarray) -> np.ndarray:
        """Points on or inside the polygon."""
        tile = self.frame.tiles_of(px, py)
        out = np.zeros(len(px), dtype=bool)
        near = np.flatnonzero(tile >= 0)
        for part in _chunks(np.diff(self.first)[tile[near]] + 1):
            some = near[part]
            t = tile[some]
            k, edge = self._candidates(t)
            e, x, y = self.e[:, edge], px[some][k], py[some][k]
            on = np.bincount(k, weights=_on(e, x, y, _side(e, x, y)), minlength=len(some)) > 0
            odd = np.bincount(k, weights=_between(e, self.rx[t][k], self.ry[t][k], x, y), minlength=len(some)) % 2 == 1
            out[some] = on | (self.inside[t] != odd)
        return out

    def meets(self, column: pa.Array, kinds: pa.Array) -> np.ndarray:
        """Geometries that share a point with the polygon. Pairs of edges are held a bounded number at a time."""
        g, solid = _Rings(column), _is_solid(kinds)
        hit = np.zeros(g.rows, dtype=bool)
        own_row, own = _edges(g, solid)
        mine, tile = self.frame.passed(own)
        for part in _chunks(np.diff(self.first)[tile] + 1):
            open_ = ~hit[own_row[mine[part]]]
            m, t = mine[part][open_], tile[part][open_]
            k, edge = self._candidates(t)
            crossing = _meet(own[:, m[k]], self.e[:, edge])
            hit[own_row[m[k[crossing]]]] = True
        row, x, y = _first_vertices(g)
        row, x, y = (v[~hit[row]] for v in (row, x, y))
        hit[row[self.holds(x, y)]] = True
        return self._around(hit, g, own_row, own, solid)

    def _around(self, hit: np.ndarray, g: _Rings, own_row, own, solid) -> np.ndarray:
        """Solids without a common edge point that hold a ring of the polygon whole."""
        left = np.flatnonzero(solid & ~hit & (np.bincount(own_row, minlength=g.rows) > 0))
        if not len(left):
            return hit
        first, end = np.searchsorted(own_row, left), np.searchsorted(own_row, left, side="right")
        reduce = lambda f, a, b: f.reduceat(np.minimum(a, b) if f is np.minimum else np.maximum(a, b), first)
        mask = np.isin(own_row, left)
        own, first = own[:, mask], np.concatenate([[0], np.cumsum(end - first)[:-1]])
        end = np.concatenate([first[1:], [own.shape[1]]])
        xmin, ymin = reduce(np.minimum, own[0], own[2]), reduce(np.minimum, own[1], own[3])
        xmax, ymax = reduce(np.maximum, own[0], own[2]), reduce(np.maximum, own[1], own[3])
        order = np.argsort(self.px)
        px, py = self.px[order], self.py[order]
        low, high = np.searchsorted(px, xmin), np.searchsorted(px, xmax, side="right")
        for part in _chunks(high - low + 1):
            k, p = _counting(low[part], high[part] - 1)
            k += part.start
            inside = (py[p] >= ymin[k]) & (py[p] <= ymax[k])
            k, p = k[inside], p[inside]
            for some in _chunks(end[k] - first[k] + 1):
                m, edge = _counting(first[k[some]], end[k[some]] - 1)
                e, x, y = own[:, edge], px[p[some]][m], py[p[some]][m]
                straddles = (e[1] > y) != (e[3] > y)
                rise = np.where(straddles, e[3] - e[1], 1.0)
                right = straddles & (x < e[0] + (y - e[1]) * (e[2] - e[0]) / rise)
                odd = np.bincount(m, weights=right, minlength=some.stop - some.start) % 2 == 1
                hit[left[k[some][odd]]] = True
        return hit


def meets(rings: Column, kind: Column, shared) -> Column:
    """Whether each geometry meets the polygon of the broadcast grid."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, kinds in batches:
            yield pa.array(shared.value.meets(column, kinds), pa.bool_())
    return F.arrow_udf(run, "boolean").asNondeterministic()(rings, kind)


# -- the same by rows of tiles, for polygons whose grid is too large to send ---------------------------

TILE_TYPE = ("array<struct<tile:bigint,inside:boolean,rx:double,ry:double,"
             "edges:array<double>,points:array<double>>>")


def _tile_rows(rings: pa.Array, solid: bool, frame: Frame) -> list[dict]:
    """Of one geometry: each tile it passes or covers, with its edges and first vertices there."""
    g = _Rings(rings)
    _, e = _edges(g, np.array([solid]))
    edge, tile = frame.passed(e)
    edge, tile = edge[np.argsort(tile, kind="stable")], np.sort(tile)
    _, px, py = _first_vertices(g)
    at = frame.tiles_of(px, py)
    every = set(tile.tolist()) | set(at[at >= 0].tolist())
    rx = ry = inside = None
    if solid and e.shape[1]:
        rx, ry, inside = _answers(frame, e)
        every |= set(np.flatnonzero(inside).tolist())
    out = []
    for t in sorted(every):
        low, high = np.searchsorted(tile, (t, t + 1))
        here = at == t
        out.append({"tile": t, "inside": bool(inside[t]) if inside is not None else False,
                    "rx": float(rx[t]) if rx is not None else 0.0, "ry": float(ry[t]) if ry is not None else 0.0,
                    "edges": e[:, edge[low:high]].T.ravel(), "points": np.stack([px[here], py[here]], 1).ravel()})
    return out


def tile_rows(rings: Column, kind: Column, frame: Frame) -> Column:
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, kinds in batches:
            solid = _is_solid(kinds)
            yield pa.array([_tile_rows(column.slice(i, 1), bool(solid[i]), frame) for i in range(len(column))],
                           pa.list_(pa.struct([("tile", pa.int64()), ("inside", pa.bool_()), ("rx", pa.float64()),
                                               ("ry", pa.float64()), ("edges", pa.list_(pa.float64())),
                                               ("points", pa.list_(pa.float64()))])))
    return F.arrow_udf(run, TILE_TYPE).asNondeterministic()(rings, kind)


def _held(points: np.ndarray, other: dict, edges: np.ndarray) -> bool:
    """Whether one of the points lies on or inside the other shape, seen in one tile."""
    for x, y in points:
        if edges.shape[1] and _on(edges, x, y, _side(edges, x, y)).any():
            return True
        odd = _between(edges, other["rx"], other["ry"], x, y).sum() % 2 == 1 if edges.shape[1] else False
        if other["inside"] != odd:
            return True
    return False


def _tile_hit(a: dict, b: dict) -> bool:
    ea, eb = (np.asarray(t["edges"], dtype=float).reshape(-1, 4).T for t in (a, b))
    step = max(1, 1_000_000 // max(eb.shape[1], 1))
    for low in range(0, ea.shape[1], step):
        if _meet(ea[:, low:low + step, None], eb[:, None, :]).any():
            return True
    pa_, pb = (np.asarray(t["points"], dtype=float).reshape(-1, 2) for t in (a, b))
    return _held(pa_, b, eb) or _held(pb, a, ea)


def tile_hit(feature: Column, polygon: Column) -> Column:
    """Whether a feature and the polygon meet, as far as one tile tells."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for f, p in batches:
            yield pa.array([_tile_hit(a, b) for a, b in zip(f.to_pylist(), p.to_pylist())], pa.bool_())
    return F.arrow_udf(run, "boolean").asNondeterministic()(feature, polygon)
