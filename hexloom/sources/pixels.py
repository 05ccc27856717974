"""Pixel tables: the grid specification of a raster and the centres of its pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexloom.functions import hexgrid as H

METRES_PER_DEGREE = 111_320.0


def pixel_scale_m(res: int) -> float:
    """Pixel size: a quarter of the cell edge, at least 10 m."""
    return max(10.0, H.edge(res) / 4.0)


def pixel_step_degrees(res: int) -> float:
    """The same size in degrees, for boxes in longitude and latitude."""
    return pixel_scale_m(res) / METRES_PER_DEGREE


def grid_shape(xmin: Column, ymin: Column, xmax: Column, ymax: Column, step: float) -> Column:
    """Width and height in pixels, at least one each."""
    side = lambda lo, hi: F.greatest(F.ceil((hi - lo) / step).cast("int"), F.lit(1))
    return F.struct(side(xmin, xmax).alias("width"), side(ymin, ymax).alias("height"))


def pixel_centres(boxes: DataFrame, step: float) -> DataFrame:
    """Centres of all pixels of every box, rows from the top; adds px, py, x, y.

    The box is divided evenly, as by a raster that fills it. Columns explode after rows, so one
    large box yields narrow rows.
    """
    c = F.col
    names = [n for n in boxes.columns if n not in ("xmin", "ymin", "xmax", "ymax")]
    shaped = boxes.withColumn("_s", grid_shape(c("xmin"), c("ymin"), c("xmax"), c("ymax"), step))
    rows = shaped.withColumn("py", F.explode(F.sequence(F.lit(0), c("_s.height") - 1)))
    cells = rows.withColumn("px", F.explode(F.sequence(F.lit(0), c("_s.width") - 1)))
    dx = (c("xmax") - c("xmin")) / c("_s.width")
    dy = (c("ymax") - c("ymin")) / c("_s.height")
    return cells.select(*names, "px", "py", (c("xmin") + (c("px") + 0.5) * dx).alias("x"),
                        (c("ymax") - (c("py") + 0.5) * dy).alias("y"))


def unpack_tile(tiles: DataFrame, bands: list[str], key: list[str]) -> DataFrame:
    """Tiles with one array per band to one row per pixel with a band array."""
    zipped = F.arrays_zip(*[F.col(b) for b in bands])
    exploded = tiles.select(*key, F.posexplode(zipped).alias("_i", "_v"))
    return exploded.select(*key, F.col("_i").alias("pixel_index"),
                           F.array(*[F.col("_v")[b] for b in bands]).alias("band"))


def tile_pixels(tiles: DataFrame, bands: list[str], key: list[str]) -> DataFrame:
    """One row per pixel of raster tiles: key, band array and the pixel centre x, y in the tile's unit.

    A tile has xmin, ymin, xmax, ymax, its width in pixels and one array per band, row by row from the
    top. A tile without pixels gives no row; where bands differ in length, the shorter end in nulls.
    """
    c = F.col
    sized = tiles.withColumn("_n", F.greatest(*[F.size(b) for b in bands], F.lit(0)))
    flat = unpack_tile(sized, bands, [*key, "xmin", "ymin", "xmax", "ymax", "width", "_n"])
    px, py = c("pixel_index") % c("width"), F.floor(c("pixel_index") / c("width"))
    height = F.ceil(c("_n") / c("width"))
    return flat.select(
        *key, "band", (c("xmin") + (px + 0.5) * ((c("xmax") - c("xmin")) / c("width"))).alias("x"),
        (c("ymax") - (py + 0.5) * ((c("ymax") - c("ymin")) / height)).alias("y"))
