"""Map layers, incidents, pixels and catalogue rows derived from the star-schema tables.

Every relation is a projection of one table (or a join with a fixed-size dimension), so the work
of a query grows with the table. Coordinates are whole numbers on a square plane of side S metres.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.functions import attributes as A
from hexloom.functions import geometry as G
from hexloom.functions import kernels as K
from hexloom.session import fill_cluster

RES = 9
SIDE = {"customer": 2000, "supplier": 700, "part": 2000, "orders": 5000, "lineitem": 5000,
        "events": 5000, "embeddings": 1000}
POI_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Named columns of a table, spread over the cluster ahead of heavy per-row work."""
    return fill_cluster(table(spark, folder, name).select(*columns))


def plane_x(key: Column, side: int) -> Column:
    return ((key * 7919) % side).cast("double")


def plane_y(key: Column, side: int) -> Column:
    return ((key * 104729) % side).cast("double")


def pois(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as places; the nation name is the alternate of every third one."""
    c, n = table(spark, folder, "customer"), table(spark, folder, "nation")
    key, side = F.col("c_custkey"), SIDE["customer"]
    named = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    return named.select(
        key.alias("feature_id"), F.col("c_mktsegment").alias("category"),
        F.when(key % 3 == 0, F.concat_ws("|", "n_name", F.concat(F.lit("S"), key % 7)))
        .alias("categories_alt"),
        plane_x(key, side).alias("x"), plane_y(key, side).alias("y"))


def addresses(spark: SparkSession, folder: str) -> DataFrame:
    s, n = table(spark, folder, "supplier"), table(spark, folder, "nation")
    key, side = F.col("s_suppkey"), SIDE["supplier"]
    return s.join(n, s["s_nationkey"] == n["n_nationkey"], "left").select(
        key.alias("feature_id"), F.col("n_name").alias("street"),
        F.when(key % 4 != 0, key.cast("string")).alias("postcode"),
        F.when(key % 3 == 0, key.cast("string")).alias("unit"),
        plane_x(key, side).alias("x"), plane_y(key, side).alias("y"))


def infrastructure(spark: SparkSession, folder: str) -> DataFrame:
    key, side = F.col("p_partkey"), SIDE["part"]
    return table(spark, folder, "part").select(
        key.alias("feature_id"), F.col("p_brand").alias("infra_class"),
        plane_x(key, side).alias("x"), plane_y(key, side).alias("y"))


def connectors(spark: SparkSession, folder: str) -> DataFrame:
    key, side = F.col("o_orderkey"), SIDE["orders"]
    return table(spark, folder, "orders").select(
        key.alias("feature_id"), plane_x(key, side).alias("x"), plane_y(key, side).alias("y"))


def nested_roads(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as two-point roads with nested attribute columns."""
    side = SIDE["lineitem"]
    okey, pkey, skey, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    key = okey * 8 + ln
    x0, y0 = plane_x(key, side), plane_y(key, side)
    text = lambda c: c.cast("string")
    one = lambda **f: F.struct(*[v.alias(k) for k, v in f.items()])
    null = F.lit(None)
    unit = F.when(ln % 2 == 0, F.lit("mph")).otherwise(F.lit("km/h"))
    speed = lambda v: one(value=v.cast("int"), unit=unit)
    during = one(during=F.when(skey % 11 == 0, F.lit("Mo-Fr")))
    surface = (F.when(pkey % 7 == 0, "asphalt").when(pkey % 7 == 1, "gravel")
               .when(pkey % 7 == 2, "paved").when(pkey % 7 == 3, "marble").when(pkey % 7 == 4, "dirt"))
    modes = F.array(F.when(pkey % 12 == 0, F.lit("foot")), F.when(skey % 4 == 0, F.lit("HGV")),
                    F.when(pkey % 18 == 0, F.lit("bicycle")))
    network = F.when(skey % 2 == 0, F.lit("AU:A")).otherwise(F.lit("AU:M"))
    lines = wide_table(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                       "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    return lines.select(
        F.concat_ws("-", okey, ln, pkey, skey).alias("feature_id"),
        F.when(F.col("l_returnflag") == "A", "primary")
        .when(F.col("l_returnflag") == "N", "residential")
        .when(okey % 2 == 0, "goat_track").alias("class"),
        F.array(one(max_speed=speed(null), min_speed=speed(null), when=one(during=null)),
                one(max_speed=speed(F.when(ln % 3 != 0, F.col("l_quantity") + 40)),
                    min_speed=speed(F.when(ln % 5 == 0, F.col("l_quantity"))), when=during))
        .cast(A.SPEED_LIMITS).alias("speed_limits"),
        F.array(one(value=null), one(value=surface)).cast(A.SURFACES).alias("road_surface"),
        F.array(one(value=null), one(value=F.when(pkey % 4 == 0, F.col("l_quantity") / 10 + 3)))
        .cast(A.WIDTHS).alias("width_rules"),
        F.array(one(value=null), one(value=skey % 5 - 2)).cast(A.LEVELS).alias("level_rules"),
        F.array(one(values=F.array(F.when(F.col("l_linestatus") == "F", F.lit("is_link")))),
                one(values=F.array(F.when(skey % 10 == 0, F.lit("Under_Construction")))))
        .alias("road_flags"),
        F.array(one(access_type=F.when(pkey % 6 == 0, F.lit("Denied")).otherwise(F.lit("allowed")),
                    when=one(mode=modes))).alias("access_restrictions"),
        F.array(one(value=F.when(okey % 5 == 0, "link").when(okey % 5 == 1, "alley")
                    .when(okey % 5 == 2, "tunnelway"))).alias("subclass_rules"),
        one(primary=F.when(pkey % 3 == 0, F.concat(F.lit("Road "), skey % 50))
            .when(pkey % 3 == 1, "")).alias("names"),
        F.array(one(network=network, ref=text(okey % 4)),
                one(network=F.lit("AU:M"), ref=F.lit("0"))).alias("routes"),
        F.array(F.array(G.point(x0, y0), G.point(x0 + (pkey % 400 - 200), y0 + (skey % 400 - 200))))
        .alias("rings"))


def roads(spark: SparkSession, folder: str) -> DataFrame:
    flat = A.road_attributes()
    return nested_roads(spark, folder).select(
        "feature_id", *[c.alias(n) for n, c in flat.items()], "rings")


def polygons(spark: SparkSession, folder: str, scale: int = 1) -> DataFrame:
    """Parts as axis-parallel squares with side p_size * scale."""
    key, side = F.col("p_partkey"), SIDE["part"]
    size = (F.col("p_size") * scale).cast("double")
    parts = wide_table(spark, folder, "part", "p_partkey", "p_type", "p_brand", "p_size", "p_retailprice")
    return parts.select(
        key.alias("feature_id"), F.col("p_type"), F.col("p_brand"), F.col("p_size"),
        F.col("p_retailprice"),
        G.square(plane_x(key, side), plane_y(key, side), size).alias("rings"))


LANDUSE_OF_TYPE = {"ECONOMY": "forest", "STANDARD": "park", "PROMO": "residential",
                   "MEDIUM": "industrial", "LARGE": "moonbase"}
COVER_OF_TYPE = {"ECONOMY": "forest", "STANDARD": "grass", "PROMO": "urban", "MEDIUM": "crop"}
CLASS_OF_TYPE = {"ECONOMY": "house", "STANDARD": "garage", "PROMO": "school", "MEDIUM": "castle"}


def mapped(column: Column, words: dict[str, str]) -> Column:
    chain = None
    for key, value in words.items():
        chain = F.when(column == key, value) if chain is None else chain.when(column == key, value)
    return chain


def landuse(spark: SparkSession, folder: str) -> DataFrame:
    return polygons(spark, folder, 10).select(
        "feature_id", F.lit("land_use").alias("land_type"),
        F.coalesce(mapped(F.col("p_type"), LANDUSE_OF_TYPE), F.lit("unknown")).alias("land_class"),
        "rings")


def land_cover(spark: SparkSession, folder: str) -> DataFrame:
    return polygons(spark, folder, 10).select(
        "feature_id", F.coalesce(mapped(F.col("p_type"), COVER_OF_TYPE), F.lit("unknown"))
        .alias("landcover_subtype"), "rings")


def bathymetry(spark: SparkSession, folder: str) -> DataFrame:
    return polygons(spark, folder, 10).select("feature_id", "rings")


def buildings(spark: SparkSession, folder: str) -> DataFrame:
    return polygons(spark, folder).select(
        "feature_id", mapped(F.col("p_type"), CLASS_OF_TYPE).alias("building_class"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_retailprice") / 100).alias("height"), "rings")


def building_parts(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    return polygons(spark, folder).select(
        "feature_id", F.when(size % 5 != 0, F.col("p_retailprice") / 100).alias("height"),
        F.when(size % 4 != 0, (size % 9).cast("double")).alias("num_floors"),
        (size % 7 == 0).alias("is_underground"), "rings")


def division_areas(spark: SparkSession, folder: str) -> DataFrame:
    return polygons(spark, folder, 10).select("feature_id", "rings")


def division_points(spark: SparkSession, folder: str) -> DataFrame:
    key, side = F.col("s_suppkey"), SIDE["supplier"]
    return table(spark, folder, "supplier").select(
        key.alias("feature_id"), F.when(key % 4 != 0, key % 9 + 1).alias("admin_level"),
        plane_x(key, side).alias("x"), plane_y(key, side).alias("y"))


def division_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Three sides of every square as one open line."""
    ring = F.get("rings", F.lit(0))
    return division_areas(spark, folder).select("feature_id", F.array(ring).alias("rings"))


def pixels(spark: SparkSession, folder: str) -> DataFrame:
    return pixel_columns(table(spark, folder, "embeddings"))


def pixel_columns(embeddings: DataFrame) -> DataFrame:
    key, side = F.col("vec_id"), SIDE["embeddings"]
    return embeddings.select(
        key.alias("pixel_id"), (key % 16).alias("tile"), F.col("embedding").alias("band"),
        plane_x(key, side).alias("x"), plane_y(key, side).alias("y"))


def boundary(spark: SparkSession, folder: str) -> DataFrame:
    """One L-shaped city outline whose size follows the nation count."""
    n = table(spark, folder, "nation").agg(F.count(F.lit(1)).cast("double").alias("n"))
    s = F.col("n") * 80.0
    corner = lambda a, b: G.point(s * a, s * b)
    return n.select(F.array(F.array(corner(0.05, 0.05), corner(0.95, 0.05), corner(0.95, 0.45),
                                    corner(0.45, 0.45), corner(0.45, 0.95), corner(0.05, 0.95)))
                    .alias("rings"))


def slit_boundary(spark: SparkSession, folder: str) -> DataFrame:
    """An outline of two parts, the larger one with a slit from its border and a hole."""
    n = table(spark, folder, "nation").agg(F.count(F.lit(1)).cast("double").alias("n"))
    s = F.col("n") * 4.0
    ring = lambda *corners: F.array(*[G.point(s * a, s * b) for a, b in corners])
    box = lambda a, b, c, d: ring((a, b), (c, b), (c, d), (a, d))
    return n.select(F.array(
        ring((1, 1), (15, 1), (15, 15), (6.4, 15), (6.4, 3), (6, 3), (6, 15), (1, 15)),
        F.reverse(box(9, 7, 12, 11)), box(16, 16, 19, 19)).alias("rings"))


def mixed_features(spark: SparkSession, folder: str) -> DataFrame:
    """Points, roads and squares of two scales; the larger squares outgrow the outlines."""
    kind = lambda df, tag, name: df.select(F.concat(F.lit(tag), F.col("feature_id")).alias("feature_id"),
                                           F.lit(name).alias("geom_type"), "rings")
    places = pois(spark, folder).select("feature_id", F.array(F.array(G.point(F.col("x"), F.col("y")))).alias("rings"))
    return (kind(places, "p", "Point").unionByName(kind(nested_roads(spark, folder), "r", "LineString"))
            .unionByName(kind(polygons(spark, folder, 10), "s", "Polygon"))
            .unionByName(kind(polygons(spark, folder, 100), "l", "Polygon")))


def _wkb_batch(names: pa.Array, shapes: pa.Array) -> pa.Array:
    """The bytes of a batch in one buffer: heads, counts and vertices are put where they belong at once."""
    points = shapes.values.values
    if any(v.null_count for v in (names, shapes, shapes.values, points.field(0), points.field(1))):
        raise ValueError("a geometry without type or coordinates has no well-known bytes")
    g = K._Rings(shapes)
    code = np.asarray(pc.index_in(names, value_set=pa.array(["Point", "LineString", "Polygon"]))) + 1
    area = code == 3
    if ((g.end_ring - g.first_ring < 1) & ~area).any():
        raise ValueError("a point or a line has one part")
    row, part = K._counting(g.first_ring, np.where(area, g.end_ring - 1, g.first_ring))
    n, sized, head = (g.stop - g.start)[part], code[row] != 1, 5 + 4 * area
    size = 16 * n + 4 * sized
    limits = np.concatenate([[0], np.cumsum(head + np.bincount(row, weights=size, minlength=g.rows).astype(np.int64))])
    data, at = np.zeros(limits[-1], dtype=np.uint8), limits[:-1]

    def put(where: np.ndarray, values: np.ndarray) -> None:
        width = values.dtype.itemsize * (2 if values.ndim == 2 else 1)
        data[where[:, None] + np.arange(width)] = values.view(np.uint8).reshape(-1, width)
    word = lambda values: values.astype("<u4")
    data[at] = 1
    put(at + 1, word(code))
    put(at[area] + 5, word((g.end_ring - g.first_ring)[area]))
    before = np.cumsum(size) - size
    first = np.searchsorted(row, np.arange(g.rows))
    block = (at + head)[row] + before - before[first[row]]
    put(block[sized], word(n[sized]))
    owner, vertex = K._counting(g.start[part], g.stop[part] - 1)
    put((block + 4 * sized)[owner] + 16 * (vertex - g.start[part][owner]),
        np.stack([g.x[vertex], g.y[vertex]], 1).astype("<f8"))
    return pa.Array.from_buffers(pa.binary(), g.rows, [None, pa.py_buffer(limits.astype(np.int32)), pa.py_buffer(data)])


def to_wkb(kind: Column, rings: Column) -> Column:
    """Well-known bytes of points, lines and polygons, little-endian with two dimensions."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for names, shapes in batches:
            yield _wkb_batch(names, shapes)
    return F.arrow_udf(run, "binary").asNondeterministic()(kind, rings)
