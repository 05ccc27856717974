"""Geometry ingest: GeoJSON text and WKB bytes to rings plus a type tag."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexloom.functions import geometry as G
from hexloom.functions import kernels as K

GEOMETRY_TYPE = f"struct<geom_type:string,rings:{G.RINGS_TYPE}>"

# Type codes of the well-known binary format.
WKB_KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString",
             6: "MultiPolygon"}

_XY = pa.struct([("x", pa.float64()), ("y", pa.float64())])


def orient(rings: Column) -> Column:
    """First ring counter-clockwise, the others clockwise."""
    def turn(ring, i):
        backwards = F.when(i == 0, G.ring_area(ring) < 0).otherwise(G.ring_area(ring) > 0)
        return F.when(backwards, F.reverse(ring)).otherwise(ring)
    return F.transform(rings, turn)


def _xy(pair: Column) -> Column:
    return G.point(F.get(pair, F.lit(0)), F.get(pair, F.lit(1)))


def geojson_rings(kind: Column, coordinates: Column) -> Column:
    """Rings from the text of a GeoJSON ``coordinates`` member."""
    read = lambda depth: F.from_json(coordinates, "array<" * depth + "double" + ">" * depth)
    line = lambda pts: F.transform(pts, _xy)
    return (F.when(kind == "Point", F.array(F.array(_xy(read(1)))))
             .when(kind == "MultiPoint", F.transform(read(2), lambda p: F.array(_xy(p))))
             .when(kind == "LineString", F.array(line(read(2))))
             .when(kind == "MultiLineString", F.transform(read(3), line))
             .when(kind == "Polygon", orient(F.transform(read(3), line)))
             .when(kind == "MultiPolygon", F.flatten(F.transform(
                 read(4), lambda poly: orient(F.transform(poly, line))))))


def from_geojson(text: Column) -> Column:
    """STRUCT<geom_type,rings>; null and empty geometries give null."""
    head = F.from_json(text, "type string, coordinates string")
    return G.bind(head, lambda h: _checked(h["type"], geojson_rings(h["type"], h["coordinates"])))


def _checked(kind: Column, rings: Column) -> Column:
    return F.when(F.size(F.flatten(rings)) > 0,
                  F.struct(kind.alias("geom_type"), rings.alias("rings")))


def _read_wkb(data: bytes) -> tuple[str | None, list[np.ndarray]]:
    """Type tag and coordinate blocks of one geometry; None for other types."""
    at = 0

    def header():
        nonlocal at
        end = "<" if data[at] == 1 else ">"
        code = struct.unpack_from(end + "I", data, at + 1)[0]
        at += 5
        if code & 0x20000000:
            at += 4
        dims = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
        flat = code & 0x0FFFFFFF
        if flat >= 1000:
            dims = 2 + (flat // 1000 in (1, 3)) + (flat // 1000 in (2, 3))
            if flat // 1000 == 3:
                dims = 4
        return end, flat % 1000, dims

    def count(end):
        nonlocal at
        n = struct.unpack_from(end + "I", data, at)[0]
        at += 4
        return n

    def block(end, n, dims):
        nonlocal at
        xy = np.frombuffer(data, dtype=end + "f8", count=n * dims, offset=at).reshape(n, dims)[:, :2]
        at += 8 * n * dims
        return xy.astype("f8", copy=False)

    def body(end, code, dims):
        if code == 1:
            return [block(end, 1, dims)]
        if code == 2:
            return [block(end, count(end), dims)]
        if code == 3:
            return [_turned(block(end, count(end), dims), k == 0) for k in range(count(end))]
        out = []
        for _ in range(count(end)):
            out += body(*header())
        return out

    end, code, dims = header()
    if code not in WKB_KINDS:
        return None, []
    parts = [p for p in body(end, code, dims) if len(p) and not np.isnan(p).all()]
    return WKB_KINDS[code], parts


def _turned(ring: np.ndarray, shell: bool) -> np.ndarray:
    if len(ring) < 3:
        return ring
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    doubled = float(np.dot(x, np.roll(y, -1)) - np.dot(np.roll(x, -1), y))
    return ring[::-1] if (doubled < 0) == shell and doubled != 0 else ring


def _vertices_at(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Coordinate pairs that start at the given bytes, a bounded number at a time."""
    out = np.empty((len(begin), 16), dtype=np.uint8)
    for low in range(0, len(begin), 1 << 16):
        out[low:low + (1 << 16)] = data[begin[low:low + (1 << 16), None] + np.arange(16)]
    return out.view("<f8").reshape(-1, 2)


def _turns(xy: np.ndarray, n: np.ndarray, owner: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of shells, given one after another: which run backwards, and which are too flat to tell by this sum."""
    if not len(xy):
        return np.zeros(len(n), dtype=bool), np.zeros(len(n), dtype=bool)
    first = np.cumsum(n) - n
    x, y = (xy - xy[first[owner]]).T
    after = np.where(k + 1 < n[owner], np.arange(len(xy)) + 1, first[owner])
    a, b = x * y[after], x[after] * y
    doubled, scale = np.add.reduceat(a - b, first), np.add.reduceat(np.abs(a) + np.abs(b), first)
    return (doubled < 0) & (n >= 3), ~(np.abs(doubled) > 1e-9 * scale) & (n >= 3)


def _plain_parts(values: pa.Array, shells: bool = False) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]], np.ndarray]:
    """Points, lines and, with ``shells``, polygons of one ring, little-endian in two dimensions, read from the batch's buffer at once.

    Returns the type code of these rows (0 for all others), one (row, points of the part) for each
    code, and the coordinates in that order.
    """
    limits = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2] or b"", dtype=np.uint8)
    at, size = limits[:-1], np.diff(limits)
    size = np.where(values.is_valid().to_numpy(zero_copy_only=False), size, 0)
    word = lambda rows, shift: data[(at[rows] + shift)[:, None] + np.arange(4)].copy().view("<u4").ravel()
    little = np.flatnonzero(size >= 9)
    little = little[data[at[little]] == 1]
    found = np.zeros(len(values), dtype=np.int64)
    code = word(little, 1)
    points = little[(code == 1) & (size[little] == 21)]

    def counted(rows, head):
        n = word(rows, head - 4).astype(np.int64)
        fits = size[rows] == head + 16 * n
        return rows[fits], n[fits]

    def vertices(rows, n, head, backwards=False):
        owner, k = np.repeat(np.arange(len(rows)), n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        if backwards is not False:
            k = np.where(backwards[owner], n[owner] - 1 - k, k)
        return owner, k, _vertices_at(data, at[rows][owner] + head + 16 * k)
    lines, n = counted(little[code == 2], 9)
    areas = little[(code == 3) & (size[little] >= 29)] if shells else little[:0]
    areas, m = counted(areas[word(areas, 5) == 1], 13)
    owner, k, xy = vertices(areas, m, 13)
    backwards, flat = _turns(xy, m, owner, k)
    areas, m, backwards = areas[~flat], m[~flat], backwards[~flat]
    found[points], found[lines], found[areas] = 1, 2, 3
    single = np.ones(len(points), dtype=np.int64)
    xy = np.concatenate([vertices(points, single, 5)[2], vertices(lines, n, 9)[2], vertices(areas, m, 13, backwards)[2]])
    return found, [(points, single), (lines, n), (areas, m)], xy


def _decode_batch(values: pa.Array, shells: bool = False) -> pa.Array:
    """Points, lines and, with ``shells``, polygons of one ring by columns, the others one geometry at a time."""
    values = values.cast(pa.binary())
    code, parts, xy = _plain_parts(values, shells)
    row, size = (np.concatenate(v) for v in zip(*parts))
    kinds = np.array([None, WKB_KINDS[1], WKB_KINDS[2], WKB_KINDS[3]], dtype=object)[code]
    blocks, more_row, more_size = [xy], [], []
    for i in np.flatnonzero(code == 0):
        raw = values[i].as_py()
        kinds[i], found = _read_wkb(raw) if raw else (None, [])
        blocks += found
        more_row += [i] * len(found)
        more_size += map(len, found)
    row, size = np.concatenate([row, more_row]).astype(np.int64), np.concatenate([size, more_size]).astype(np.int64)
    xy = np.concatenate(blocks)
    begin = np.cumsum(size) - size
    # a part without a number is no part
    empty = np.concatenate([[0], np.cumsum(~np.isnan(xy).all(axis=1))])
    real = empty[begin + size] > empty[begin]
    order = np.flatnonzero(real)[np.argsort(row[real], kind="stable")]
    row, size, begin = row[order], size[order], begin[order]
    take = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    outer = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(values)))])
    kinds[np.diff(outer) == 0] = None
    points = pa.StructArray.from_arrays([pa.array(xy[take, 0]), pa.array(xy[take, 1])], fields=list(_XY))
    lines = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), points)
    rings = pa.ListArray.from_arrays(pa.array(outer, pa.int32()), lines)
    return pa.StructArray.from_arrays([pa.array(kinds.tolist(), pa.string()), rings], names=["geom_type", "rings"])


def _wkb_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield _decode_batch(batch)


def from_wkb(data: Column) -> Column:
    """STRUCT<geom_type,rings> from bytes, one Arrow batch at a time.

    Marked as not deterministic, so a filter on the result isn't pushed below it, which would decode twice.
    """
    return F.arrow_udf(_wkb_batches, GEOMETRY_TYPE).asNondeterministic()(data)


def _box_meets(g: K._Rings, box: tuple[float, float, float, float]) -> np.ndarray:
    """Rows whose vertices' box meets the given one. NaN is the largest number, as for Column functions."""
    row, ring = g.by_ring()
    owner, at = K._counting(g.start[ring], g.stop[ring] - 1)
    row = row[owner]
    used = np.unique(row)
    out = np.zeros(g.rows, dtype=bool)
    if len(used):
        first = np.searchsorted(row, used)
        least = lambda v: np.fmin.reduceat(v[at], first)
        most = lambda v: np.nan_to_num(np.maximum.reduceat(v[at], first), nan=np.inf, posinf=np.inf, neginf=-np.inf)
        out[used] = ((least(g.x) <= box[2]) & (most(g.x) >= box[0]) & (least(g.y) <= box[3]) & (most(g.y) >= box[1]))
    return out


def ring_areas(column: pa.Array) -> np.ndarray:
    """Signed area of every row, ``geometry.area`` step by step: all rings take the same vertex at a time."""
    g = K._Rings(column)
    row, ring = g.by_ring()
    n = (g.stop - g.start)[ring]
    solid = np.flatnonzero(n >= 3)
    solid = solid[np.argsort(-n[solid], kind="stable")]
    n, start = n[solid], g.start[ring[solid]]
    ox, oy = g.x[start], g.y[start]
    px, py = g.x[start + n - 1] - ox, g.y[start + n - 1] - oy
    total = np.zeros(len(solid))
    open_ = np.searchsorted(-n, -np.arange(n[0]) if len(n) else [], side="left")
    for k, m in enumerate(open_):
        x, y = g.x[start[:m] + k] - ox[:m], g.y[start[:m] + k] - oy[:m]
        total[:m] = (total[:m] + px[:m] * y) - x * py[:m]
        px[:m], py[:m] = x, y
    each = np.zeros(len(ring))
    each[solid] = total / 2
    out = np.zeros(g.rows)
    np.add.at(out, row, each)
    return out


def from_wkb_within(data: Column, grid, box: tuple[float, float, float, float], zone: tuple[int, bool] | None = None) -> Column:
    """STRUCT<geom_type,rings,area_m2> of the geometries that meet the polygon of a broadcast edge grid, else null.

    Decoding, both tests and the area in metres of ``zone`` (null without one) share one Python worker and one
    exchange with it; only what meets the polygon goes back.
    """
    def located(values: pa.Array) -> pa.Array:
        shape = _decode_batch(values, shells=True)
        kinds, rings = shape.field(0), shape.field(1)
        near = np.flatnonzero(_box_meets(K._Rings(rings), box))
        near = near[grid.value.meets(rings.take(pa.array(near)), kinds.take(pa.array(near)))] if len(near) else near
        kinds, rings = kinds.take(pa.array(near)), rings.take(pa.array(near))
        areas = pa.nulls(len(near), pa.float64()) if zone is None or not len(near) else pa.array(ring_areas(K.utm_batch(rings, *zone)))
        found = pa.StructArray.from_arrays([kinds, rings, areas], names=["geom_type", "rings", "area_m2"])
        back = np.full(len(values), -1)
        back[near] = np.arange(len(near))
        return found.take(pa.array(back, mask=back < 0))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield located(batch)
    return F.arrow_udf(run, f"struct<geom_type:string,rings:{G.RINGS_TYPE},area_m2:double>").asNondeterministic()(data)


def decode(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Replace a WKB or GeoJSON column by ``geom_type`` and ``rings``; decoded input passes."""
    if "rings" in df.columns:
        return df
    kind = df.schema[geometry].dataType.typeName()
    shape = from_wkb(F.col(geometry)) if kind == "binary" else from_geojson(F.col(geometry))
    names = [c for c in df.columns if c != geometry]
    return (df.withColumn("_g", shape)
            .select(*names, F.col("_g.geom_type").alias("geom_type"), F.col("_g.rings").alias("rings"))
            .where(F.col("geom_type").isNotNull()))
