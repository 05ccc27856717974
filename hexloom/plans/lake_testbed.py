"""Lake types in longitude and latitude with well-known bytes, derived from the star-schema tables.

A row's plane coordinates (see ``testbed``) are counted in steps of 1e-5 degrees from one corner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom import schema as S
from hexloom.functions import geometry as G
from hexloom.plans import testbed as TB
from hexloom.sources import pixels as PX

LON, LAT = 151.0, -34.0
STEPS = 100_000.0                 # to one degree
OFFSET = (0.3719, 0.2917)         # keeps the outline off the lattice of the features


def lon_lat(x: Column, y: Column) -> Column:
    return G.point(LON + x / STEPS, LAT + y / STEPS)


def outline(spark: SparkSession, folder: str) -> DataFrame:
    """The L-shaped city outline of ``testbed.boundary`` in degrees."""
    moved = lambda p: lon_lat(p.x + OFFSET[0], p.y + OFFSET[1])
    rings = F.transform("rings", lambda ring: F.transform(ring, moved))
    return TB.boundary(spark, folder).select(rings.alias("rings"))


def lake_rows(df: DataFrame, lake_type: str, key: Column, kind: Column, x0: Column, y0: Column,
              x1: Column, y1: Column, **columns: Column) -> DataFrame:
    """Rows of one lake type: a point, a straight line or a rectangle from one corner to another."""
    a, b = lon_lat(x0, y0), lon_lat(x1, y1)
    box = [a, G.point(b.x, a.y), b, G.point(a.x, b.y), a]
    rings = F.array(F.when(kind == "Point", F.array(a)).when(kind == "LineString", F.array(a, b))
                    .otherwise(F.array(*box)))
    ends = dict(xmin=F.least(a.x, b.x), xmax=F.greatest(a.x, b.x), ymin=F.least(a.y, b.y), ymax=F.greatest(a.y, b.y))
    given = {"id": key.cast("string"), "geometry": TB.to_wkb(kind, rings),
             "bbox": F.struct(*[v.alias(n) for n, v in ends.items()]), **columns}
    shape = df.sparkSession.createDataFrame([], S.LAKE_TYPES[lake_type][1]).schema
    return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in shape.fields])


def _squares(spark: SparkSession, folder: str, lake_type: str, scale: int, where: str = "true",
             kind: Column | None = None, **columns: Column) -> DataFrame:
    parts = TB.wide_table(spark, folder, "part", "p_partkey", "p_type", "p_brand", "p_size", "p_retailprice")
    key, side = F.col("p_partkey"), TB.SIDE["part"]
    x, y, size = TB.plane_x(key, side), TB.plane_y(key, side), F.col("p_size") * scale
    return lake_rows(parts.where(where), lake_type, key, F.lit("Polygon") if kind is None else kind, x, y, x + size, y + size, **columns)


def _points(df: DataFrame, lake_type: str, key: str, side: int, kind: Column | None = None, **columns: Column) -> DataFrame:
    x, y = TB.plane_x(F.col(key), side), TB.plane_y(F.col(key), side)
    return lake_rows(df, lake_type, F.col(key), F.lit("Point") if kind is None else kind, x, y, x + 5, y + 5, **columns)


def segment(spark: SparkSession, folder: str) -> DataFrame:
    """Roads; the seventh line of an order is a railway, every fiftieth part's a point."""
    roads = TB.nested_roads(spark, folder)
    part = lambda i: F.split_part("feature_id", F.lit("-"), F.lit(i)).cast("int")
    a, b = (F.get(F.get("rings", F.lit(0)), F.lit(i)) for i in (0, 1))
    same = [c for c in roads.columns if c not in ("feature_id", "rings")]
    return lake_rows(roads, "segment", F.col("feature_id"),
                     F.when(part(3) % 50 == 0, "Point").otherwise("LineString"), a.x, a.y, b.x, b.y,
                     subtype=F.when(part(2) == 7, "rail").otherwise("road"), **{c: F.col(c) for c in same})


def place(spark: SparkSession, folder: str) -> DataFrame:
    """Customers; every tenth is an area, every seventh has no category, every fifth no name."""
    key = F.col("c_custkey")
    alternates = F.when(key % 3 == 0, F.array(F.concat(F.lit("S"), key % 7), F.lit(None), F.lit("shop")))
    return _points(
        TB.wide_table(spark, folder, "customer", "c_custkey", "c_mktsegment"), "place", "c_custkey", TB.SIDE["customer"],
        F.when(key % 10 == 0, "Polygon").otherwise("Point"),
        names=F.struct(F.when(key % 5 != 0, F.concat(F.lit("Place "), key)).alias("primary")),
        categories=F.struct(F.when(key % 7 != 0, F.col("c_mktsegment")).alias("primary"), alternates.alias("alternate")),
        confidence=(key % 100) / 100.0)


def building(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    return _squares(
        spark, folder, "building", 1, **{"class": TB.mapped(F.col("p_type"), TB.CLASS_OF_TYPE)},
        height=F.when(size % 5 != 0, F.col("p_retailprice") / 100), num_floors=F.when(size % 4 != 0, size % 9),
        roof_shape=F.col("p_brand"), is_underground=F.when(size % 3 != 0, size % 7 == 0))


def building_part(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    return _squares(
        spark, folder, "building_part", 1, building_id=F.concat(F.lit("b"), F.col("p_partkey") % 100),
        height=F.when(size % 5 != 0, F.col("p_retailprice") / 100), num_floors_underground=F.when(size % 2 == 0, size % 3),
        min_height=F.when(size % 6 == 0, size / 10), is_underground=F.when(size % 3 != 0, size % 7 == 0))


def land_use(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    return _squares(spark, folder, "land_use", 10, "p_partkey % 3 = 0", **{"class": TB.mapped(F.col("p_type"), TB.LANDUSE_OF_TYPE)},
                    subtype=F.col("p_brand"), surface=F.when(size % 2 == 0, "grass"))


def land(spark: SparkSession, folder: str) -> DataFrame:
    """Every fourth size is a line, which the layer leaves out."""
    size = F.col("p_size")
    return _squares(spark, folder, "land", 10, "p_partkey % 3 = 1",
                    F.when(size % 4 == 0, "LineString").otherwise("Polygon"),
                    **{"class": TB.mapped(F.col("p_type"), TB.LANDUSE_OF_TYPE)}, surface=F.when(size % 2 == 0, "rock"))


def water(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    return _squares(spark, folder, "water", 10, "p_partkey % 3 = 2", **{"class": TB.mapped(F.col("p_type"), TB.LANDUSE_OF_TYPE)},
                    is_salt=F.when(size % 3 != 0, size % 2 == 0), is_intermittent=size % 5 == 0)


def infrastructure(spark: SparkSession, folder: str) -> DataFrame:
    """Points, lines and areas, all of which stay."""
    key = F.col("p_partkey")
    kind = F.when(key % 3 == 0, "Point").when(key % 3 == 1, "LineString").otherwise("Polygon")
    return _squares(spark, folder, "infrastructure", 1, "true", kind,
                    **{"class": F.when(key % 5 != 0, F.col("p_brand"))}, subtype=F.col("p_type"))


def land_cover(spark: SparkSession, folder: str) -> DataFrame:
    return _squares(spark, folder, "land_cover", 10, subtype=TB.mapped(F.col("p_type"), TB.COVER_OF_TYPE))


def bathymetry(spark: SparkSession, folder: str) -> DataFrame:
    return _squares(spark, folder, "bathymetry", 10, "p_partkey % 2 = 0")


def address(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return _points(TB.table(spark, folder, "supplier"), "address", "s_suppkey", TB.SIDE["supplier"],
                   number=key % 90, street=F.concat(F.lit("Street "), F.col("s_nationkey")),
                   postcode=F.when(key % 4 != 0, key), unit=F.when(key % 3 == 0, key), country=F.lit("AU"))


def connector(spark: SparkSession, folder: str) -> DataFrame:
    return _points(TB.wide_table(spark, folder, "orders", "o_orderkey"), "connector", "o_orderkey", TB.SIDE["orders"])


def division(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return _points(TB.table(spark, folder, "supplier"), "division", "s_suppkey", TB.SIDE["supplier"],
                   subtype=F.lit("locality"), **{"class": F.when(key % 2 == 0, "town")},
                   admin_level=F.when(key % 4 != 0, key % 9 + 1), population=key * 1000)


def division_area(spark: SparkSession, folder: str) -> DataFrame:
    """Every fourth size is a line, which the layer leaves out."""
    size = F.col("p_size")
    return _squares(spark, folder, "division_area", 10, "true", F.when(size % 4 == 0, "LineString").otherwise("Polygon"),
                    subtype=F.col("p_type"), **{"class": F.lit("land")}, admin_level=size % 6, is_land=size % 2 == 0)


def division_boundary(spark: SparkSession, folder: str) -> DataFrame:
    return _squares(spark, folder, "division_boundary", 10, "true", F.lit("LineString"))


TYPES = {f.__name__: f for f in (
    segment, place, building, building_part, land_use, land, water, infrastructure, land_cover, bathymetry,
    address, connector, division, division_area, division_boundary)}


def raster_tiles(spark: SparkSession, folder: str, res: int, bands: list[str]) -> DataFrame:
    """Embeddings as raster tiles of 2 x 2 pixels, one array per band; pixel p turns the vector by 16 p."""
    key, side = F.col("vec_id"), TB.SIDE["embeddings"]
    corner = lon_lat(TB.plane_x(key, side), TB.plane_y(key, side))
    size = 2 * PX.pixel_step_degrees(res)
    value = lambda i: F.get("embedding", F.lit(i % len(bands)))
    made = [F.array(*[value(i + 16 * p) for p in range(4)]).alias(b) for i, b in enumerate(bands)]
    return TB.table(spark, folder, "embeddings").select(
        key.alias("tile"), corner.x.alias("xmin"), corner.y.alias("ymin"), (corner.x + size).alias("xmax"),
        (corner.y + size).alias("ymax"), F.lit(2).alias("width"), *made)
