"""Overlay of points, lines and polygons with the hexagon grid, and the boundary filter.

No relation of cells is joined against: the cells a feature can reach follow from arithmetic on
its coordinates, so an overlay is a map-side expansion without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexloom.functions import edge_grid as EG
from hexloom.functions import geometry as G
from hexloom.functions import hexgrid as H
from hexloom.functions import kernels as K
from hexloom.functions.kernels import BLOCK
from hexloom.functions.plan import once

PIECE_BLOCKS = 64    # blocks that a piece of a polygon reaches at most


@dataclass(frozen=True)
class Bounds:
    xmin: float
    ymin: float
    xmax: float
    ymax: float


def measure_boundary(boundary: DataFrame, rings: str = "rings") -> tuple[Bounds, int]:
    """Bounds and number of vertices of a one-row boundary; only these reach the driver."""
    shape = boundary.select(G.bounds(F.col(rings)).alias("b"), F.size(F.flatten(rings)).alias("n"))
    row = shape.agg(F.min("b.xmin"), F.min("b.ymin"), F.max("b.xmax"), F.max("b.ymax"),
                    F.sum("n"), F.count(F.lit(1))).first()
    if row[0] is None:
        raise ValueError("boundary has no coordinates")
    if row[5] != 1:
        raise ValueError("a boundary is one row; put several parts into its rings")
    return Bounds(*row[:4]), row[4]


def bounds_of(boundary: DataFrame, rings: str = "rings") -> Bounds:
    return measure_boundary(boundary, rings)[0]


def assign_points(df: DataFrame, res: int, x: Column, y: Column, cell: str = "cell_id") -> DataFrame:
    return df.withColumn(cell, H.cell_of(x, y, res))


# -- lines ---------------------------------------------------------------------------------------

def clip_lines(lines: DataFrame, res: int, parts: str = "rings", measure: str = "length_m") -> DataFrame:
    """One row per (line, cell) with the length inside the cell. The geometry is dropped."""
    others = [c for c in lines.columns if c != parts]
    return (lines.select(*others, once(F.col(parts)).alias("_g"))
            .select(*others, K.line_pieces(F.col("_g"), res).alias("_p"))
            .select(*others, F.explode("_p").alias("_p"))
            .select(*others, H.cell_name(F.col("_p.q"), F.col("_p.r"), res).alias("cell_id"),
                    F.col("_p.m").alias(measure)))


# -- polygons ------------------------------------------------------------------------------------

def _block_ranges(box: Column, res: int) -> Column:
    """Blocks of BLOCK x BLOCK cells in offset coordinates that a box can reach."""
    e = H.edge(res)
    w = H.SQRT3 * e
    r0, r1 = H.row_range(box["ymin"], box["ymax"], res)
    c0 = F.ceil(box["xmin"] / w - 1.0).cast("long")
    c1 = F.floor(box["xmax"] / w + 0.5).cast("long")
    per = lambda v: F.floor(v / float(BLOCK)).cast("long")
    return F.struct(per(c0).alias("i0"), per(c1).alias("i1"),
                    per(r0).alias("j0"), per(r1).alias("j1"))


def _block_box(i: Column, j: Column, res: int) -> dict[str, Column]:
    e = H.edge(res)
    w = H.SQRT3 * e
    return {"xmin": i * BLOCK * w - w / 2, "xmax": (i * BLOCK + BLOCK) * w,
            "ymin": j * BLOCK * (1.5 * e) - e,
            "ymax": (j * BLOCK + BLOCK - 1) * (1.5 * e) + e}


def split_to_blocks(polygons: DataFrame, res: int, rings: str = "rings",
                    region: Bounds | None = None, spread: bool = True) -> DataFrame:
    """Cut polygons into blocks of cells; adds the block coordinates ``_i`` and ``_j``.

    A polygon over many blocks is halved again and again until its pieces reach few; with ``spread``
    the pieces are redistributed, so a country-sized polygon does not stay in one task. All polygons
    take this one way, so the source is read once.
    """
    others = [c for c in polygons.columns if c != rings]
    box = once(G.bounds(F.col(rings)))
    located = polygons.select(*others, rings, box.alias("_box")).where(F.col("_box").isNotNull())
    reach = F.col("_box")
    if region is not None:
        b = F.col("_box")
        located = located.where(G.overlaps_box(b, region.xmin, region.ymin, region.xmax, region.ymax))
        reach = F.struct(F.greatest(b.xmin, F.lit(region.xmin)).alias("xmin"),
                         F.greatest(b.ymin, F.lit(region.ymin)).alias("ymin"),
                         F.least(b.xmax, F.lit(region.xmax)).alias("xmax"),
                         F.least(b.ymax, F.lit(region.ymax)).alias("ymax"))
    ranged = located.withColumn("_n", _block_ranges(reach, res))
    pieces = (ranged.select(*others, "_box", K.halves(F.col(rings), F.col("_n"), res, PIECE_BLOCKS).alias("_p"))
              .select(*others, "_box", F.explode("_p").alias("_p")))
    if spread:
        pieces = pieces.repartition("_box", "_p.i0", "_p.j0")
    pieces = (pieces.select(*others, "_p", F.when(F.col("_p.cut"), G.bounds(F.col("_p.rings"))).otherwise(F.col("_box")).alias("_box"))
              .select(*others, "_p", "_box", F.explode(H.span(F.col("_p.i0"), F.col("_p.i1"))).alias("_i"))
              .select(*others, F.col("_p.rings").alias(rings), "_box", "_i",
                      F.explode(H.span(F.col("_p.j0"), F.col("_p.j1"))).alias("_j")))

    rect, b = _block_box(F.col("_i"), F.col("_j"), res), F.col("_box")
    inside = ((b.xmin >= rect["xmin"]) & (b.xmax <= rect["xmax"])
              & (b.ymin >= rect["ymin"]) & (b.ymax <= rect["ymax"]))
    cut = K.cut_to_box(F.when(~inside, F.col(rings)), rect["xmin"], rect["ymin"], rect["xmax"], rect["ymax"])
    return (pieces.select(*others, "_i", "_j", inside.alias("_in"), rings, cut.alias("_cut"))
            .select(*others, "_i", "_j", F.when(F.col("_in"), F.col(rings)).otherwise(F.col("_cut")).alias(rings))
            .where(F.size(rings) > 0))


def clip_polygons(polygons: DataFrame, res: int, rings: str = "rings", measure: str = "area_m2",
                  region: Bounds | None = None, spread: bool = True) -> DataFrame:
    """One row per (polygon, cell) with the overlapping area. The geometry is dropped."""
    others = [c for c in polygons.columns if c not in (rings, measure)]
    source = polygons.select(*others, rings)
    blocks = split_to_blocks(source, res, rings, region, spread)
    pieces = K.polygon_pieces(F.col(rings), F.col("_i"), F.col("_j"), res)
    return (blocks.select(*others, pieces.alias("_p"))
            .select(*others, F.explode("_p").alias("_p"))
            .select(*others, H.cell_name(F.col("_p.q"), F.col("_p.r"), res).alias("cell_id"),
                    F.col("_p.m").alias(measure)))


def hex_grid(boundary: DataFrame, res: int, rings: str = "rings", spread: bool = True) -> DataFrame:
    """Cells whose centre lies inside each boundary: its other columns, cell_id, q, r, cell_area_m2."""
    others = [c for c in boundary.columns if c != rings]
    blocks = split_to_blocks(boundary, res, rings, None, spread)
    cells = K.covered_cells(F.col(rings), F.col("_i"), F.col("_j"), res)
    p = blocks.select(*others, cells.alias("_p")).select(*others, F.explode("_p").alias("_p"))
    return p.select(*others, H.cell_name(F.col("_p.q"), F.col("_p.r"), res).alias("cell_id"),
                    F.col("_p.q").alias("q"), F.col("_p.r").alias("r"),
                    F.lit(H.true_cell_area(res)).alias("cell_area_m2"))


# -- boundary filter -----------------------------------------------------------------------------

# The grid holds some 100 bytes for each vertex and 25 for each of 65,536 tiles at most: up to this
# many vertices it stays below about 50 MB and is sent everywhere.
BROADCAST_VERTICES = 500_000


def shared_grid(boundary: DataFrame, rings: str = "rings"):
    """The broadcast edge grid of a boundary of at most ``BROADCAST_VERTICES`` vertices."""
    outline = boundary.select(F.col(rings).cast(G.RINGS_TYPE).alias("g")).toArrow()["g"].combine_chunks()
    return boundary.sparkSession.sparkContext.broadcast(EG.EdgeGrid(outline))


def filter_intersecting(features: DataFrame, boundary: DataFrame, rings: str = "rings",
                        kind: str = "geom_type", boundary_rings: str = "rings") -> DataFrame:
    """Features that meet the boundary polygon (even-odd rule); touching counts.

    The boundary's edges lie on a grid of tiles with one inside/outside answer for each tile. A
    feature's edges are compared with the boundary's edges of the same tiles only. The grid of a
    boundary of checked size is broadcast, so nothing is joined or shuffled; for a larger one both
    sides become rows of tiles, joined by tile.
    """
    box, vertices = measure_boundary(boundary, boundary_rings)
    f = F.col("_fb")
    near = (features.withColumn("_fb", once(G.bounds(F.col(rings))))
            .where(G.overlaps_box(f, box.xmin, box.ymin, box.xmax, box.ymax)).drop("_fb"))
    if vertices <= BROADCAST_VERTICES:
        return (near.withColumn("_hit", EG.meets(F.col(rings), F.col(kind), shared_grid(boundary, boundary_rings))).where("_hit")
                .select(*features.columns))
    frame = EG.Frame(box.xmin, box.ymin, box.xmax, box.ymax, vertices)
    tiles = (boundary.select(F.explode(EG.tile_rows(F.col(boundary_rings), F.lit("Polygon"), frame)).alias("_b"))
             .select(F.col("_b.tile").alias("_tile"), "_b"))
    # equal geometries have equal answers, so two hashes of the geometry name it
    key = [F.xxhash64(F.lit(i), F.col(rings), F.col(kind)).alias(n) for i, n in ((1, "_h"), (2, "_g"))]
    pieces = (near.select(*key, F.explode(EG.tile_rows(F.col(rings), F.col(kind), frame)).alias("_f"))
              .select("_h", "_g", F.col("_f.tile").alias("_tile"), "_f"))
    hits = (pieces.join(tiles.hint("merge"), "_tile").where(EG.tile_hit(F.col("_f"), F.col("_b")))
            .select("_h", "_g").distinct())
    return (near.select("*", *key).join(hits.hint("merge"), ["_h", "_g"], "left_semi")
            .select(*features.columns))
