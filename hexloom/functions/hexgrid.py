"""Planar grid of pointy-top hexagons in projected metres.

The centre of cell (q, r) is x = sqrt(3)*edge*(q + r/2), y = 1.5*edge*r. A cell id is the text
``resolution:q:r``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexloom.functions import geometry as G

# Average edge length in metres by resolution.
EDGE_M = {4: 22606, 5: 8545, 6: 3229, 7: 1220, 8: 461, 9: 174, 10: 65, 11: 25}

SQRT3 = math.sqrt(3.0)


def edge(res: int) -> float:
    return float(EDGE_M[res])


def true_cell_area(res: int) -> float:
    return 1.5 * SQRT3 * edge(res) ** 2


def nearest(value: Column) -> Column:
    """Nearest integer, halves upwards; stays in primitive arithmetic."""
    return F.floor(value + 0.5).cast("long")


def axial(x: Column, y: Column, res: int) -> tuple[Column, Column]:
    """Cell coordinates of a point by rounding in cube space."""
    e = edge(res)
    fq = x / (SQRT3 * e) - y / (3.0 * e)
    fr = y / (1.5 * e)
    fs = -fq - fr
    q, r, s = nearest(fq), nearest(fr), nearest(fs)
    dq, dr, ds = F.abs(q - fq), F.abs(r - fr), F.abs(s - fs)
    fixed_q = F.when((dq > dr) & (dq > ds), -r - s).otherwise(q)
    fixed_r = F.when(~((dq > dr) & (dq > ds)) & (dr > ds), -q - s).otherwise(r)
    return fixed_q, fixed_r


def cell_name(q: Column, r: Column, res: int) -> Column:
    return F.concat(F.lit(f"{res}:"), q.cast("string"), F.lit(":"), r.cast("string"))


def cell_of(x: Column, y: Column, res: int) -> Column:
    q, r = axial(x, y, res)
    return cell_name(q, r, res)


def resolution_of(cell: Column) -> Column:
    return F.split_part(cell, F.lit(":"), F.lit(1)).cast("int")


def coordinates_of(cell: Column) -> tuple[Column, Column]:
    return (F.split_part(cell, F.lit(":"), F.lit(2)).cast("long"),
            F.split_part(cell, F.lit(":"), F.lit(3)).cast("long"))


def centre(q: Column, r: Column, res: int) -> tuple[Column, Column]:
    e = edge(res)
    return (q + r / 2.0) * (SQRT3 * e), r * (1.5 * e)


def outline(q: Column, r: Column, res: int) -> Column:
    """The six corners of a cell, counter-clockwise, as polygon rings."""
    e = edge(res)
    cx, cy = centre(q, r, res)
    w = SQRT3 * e / 2
    corners = ((w, -e / 2), (w, e / 2), (0.0, e), (-w, e / 2), (-w, -e / 2), (0.0, -e))
    return F.array(F.array(*[G.point(cx + dx, cy + dy) for dx, dy in corners]))


def row_range(ymin: Column, ymax: Column, res: int) -> tuple[Column, Column]:
    """Rows whose cells can reach the given band."""
    e = edge(res)
    return (F.ceil((ymin - e) / (1.5 * e)).cast("long"),
            F.floor((ymax + e) / (1.5 * e)).cast("long"))


def span(lo: Column, hi: Column) -> Column:
    """Ascending whole numbers lo..hi, empty when hi < lo."""
    return F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
