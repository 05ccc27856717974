"""Queries of the geo feature pipeline over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom import schema as S
from hexloom.functions import geometry as G
from hexloom.functions import hexgrid as H
from hexloom.functions import projection as P
from hexloom.operators import features as FE
from hexloom.operators import spatial as SP
from hexloom.plans import testbed as TB
from hexloom.sources import lake, pixels as PX
from hexloom.sources.geometry_decode import decode, from_geojson
from hexloom.streaming import pixels as PS
from hexloom.streaming.incidents import scratch
from hexloom.streaming.replay import replay

RES = TB.RES


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison: sums depend on the order of addition."""
    return df.selectExpr(*[f"round(`{f.name}`, {digits}) AS `{f.name}`"
                           if f.dataType.typeName() == "double" else f"`{f.name}`"
                           for f in df.schema.fields])


def at_points(df: DataFrame) -> DataFrame:
    return SP.assign_points(df, RES, F.col("x"), F.col("y"))


def at_centroids(df: DataFrame) -> DataFrame:
    """Centroid cell and area of polygon layers."""
    measured = df.withColumn("_c", G.centroid(F.col("rings"))).withColumn(
        "area_m2", G.area(F.col("rings")))
    return SP.assign_points(measured, RES, F.col("_c.x"), F.col("_c.y")).drop("_c", "rings")


def grid(spark: SparkSession, folder: str) -> DataFrame:
    return SP.hex_grid(TB.boundary(spark, folder), RES).select("cell_id", "cell_area_m2")


# -- layer aggregates ----------------------------------------------------------------------------

def poi_layer(spark, folder):
    return FE.poi_features(at_points(TB.pois(spark, folder)), TB.POI_SEGMENTS)


def address_layer(spark, folder):
    return FE.address_features(at_points(TB.addresses(spark, folder)))


INFRA_BRANDS = [f"Brand#{i}" for i in range(1, 21)]


def infrastructure_layer(spark, folder):
    items = at_points(TB.infrastructure(spark, folder))
    layer = FE.infrastructure_features(items, INFRA_BRANDS)
    return layer.withColumnsRenamed({c: c.replace("#", "_") for c in layer.columns if "#" in c})


def connector_layer(spark, folder):
    return FE.connector_features(at_points(TB.connectors(spark, folder)), RES)


def road_layer(spark, folder):
    return FE.road_features(SP.clip_lines(TB.roads(spark, folder), RES))


def building_layer(spark, folder):
    return FE.building_features(at_centroids(TB.buildings(spark, folder)))


def building_part_layer(spark, folder):
    return FE.building_part_features(at_centroids(TB.building_parts(spark, folder)))


def landuse_layer(spark, folder):
    return FE.landuse_features(SP.clip_polygons(TB.landuse(spark, folder), RES))


def land_cover_layer(spark, folder):
    return FE.land_cover_features(SP.clip_polygons(TB.land_cover(spark, folder), RES))


def bathymetry_layer(spark, folder):
    return FE.bathymetry_features(SP.clip_polygons(TB.bathymetry(spark, folder), RES), RES)


def division_layer(spark, folder):
    return FE.division_features(
        at_points(TB.division_points(spark, folder)),
        SP.clip_polygons(TB.division_areas(spark, folder), RES),
        SP.clip_lines(TB.division_lines(spark, folder), RES))


# -- registered queries --------------------------------------------------------------------------

def poi_hex_features(spark, folder):
    """Places per cell on the grid of the boundary, gaps filled with zero."""
    return rounded(FE.join_on_grid(grid(spark, folder), [poi_layer(spark, folder)]))


def address_hex(spark, folder):
    return rounded(address_layer(spark, folder))


def infra_hex(spark, folder):
    return rounded(infrastructure_layer(spark, folder))


def connector_density(spark, folder):
    return rounded(connector_layer(spark, folder))


def _road_columns(spark, folder, names):
    return rounded(road_layer(spark, folder).select("cell_id", *names), 4)


def road_hex_core(spark, folder):
    return _road_columns(spark, folder, [
        "total_road_length_m", "road_segment_count", "avg_edge_length_m"])


ROAD_CLASS_NAMES = ["primary", "residential", "unknown", "motorway", "other"]
SURFACE_NAMES = ["asphalt", "gravel", "paved", "dirt", "sett", "other"]
SUBCLASS_NAMES = ["link", "alley", "driveway", "other"]


def road_class_lengths(spark, folder):
    return _road_columns(spark, folder, [f"road_length_{c}_m" for c in ROAD_CLASS_NAMES]
                         + [f"road_length_subclass_{c}_m" for c in SUBCLASS_NAMES])


def road_speed_weighted(spark, folder):
    return _road_columns(spark, folder, [
        "avg_maxspeed_kmh", "maxspeed_coverage_pct", "avg_min_speed_kmh",
        "min_speed_coverage_pct", "has_variable_speed_pct"])


def road_flag_fractions(spark, folder):
    return _road_columns(spark, folder, [
        "pct_is_bridge_length", "pct_is_tunnel_length", "pct_is_link_length",
        "pct_is_under_construction_length", "pct_access_denied_foot_length",
        "pct_access_denied_bicycle_length", "pct_access_denied_hgv_length",
        "has_access_restriction_pct"])


def road_surface_width(spark, folder):
    return _road_columns(spark, folder, [
        "road_surface_coverage_pct", "road_surface_paved_pct", "road_surface_unpaved_pct",
        *[f"road_surface_length_{c}_m" for c in SURFACE_NAMES],
        "road_width_coverage_pct", "avg_road_width_m", "max_road_width_m"])


def road_names_routes(spark, folder):
    return _road_columns(spark, folder, [
        "named_road_pct", "unique_road_names", "route_count_total", "has_national_route"])


def road_attributes(spark, folder):
    """Every nested road parser, one row per road."""
    return rounded(TB.roads(spark, folder).drop("rings"), 6)


def building_hex(spark, folder):
    names = ["house", "garage", "school", "unknown", "barn", "other"]
    return rounded(building_layer(spark, folder).select(
        "cell_id", "building_count", "building_total_area_m2", "avg_building_height_m",
        *[f"building_count_{c}" for c in names], *[f"building_area_{c}_m2" for c in names]), 9)


def building_part_hex(spark, folder):
    return rounded(building_part_layer(spark, folder), 9)


def landuse_hex(spark, folder):
    names = ["forest", "park", "residential", "industrial", "zoo", "other"]
    return rounded(landuse_layer(spark, folder).select(
        "cell_id", "landuse_total_area_m2", *[f"landuse_area_{c}_m2" for c in names],
        "total_green_fraction", "total_built_fraction"), 4)


def landcover_fraction(spark, folder):
    return rounded(land_cover_layer(spark, folder), 4)


def bathymetry_hex(spark, folder):
    return rounded(bathymetry_layer(spark, folder), 4)


def division_counts(spark, folder):
    return rounded(division_layer(spark, folder), 4)


def _outlines(spark, folder):
    return TB.polygons(spark, folder, 10).select("feature_id", "rings")


def hex_grid(spark, folder):
    """Cells whose centre lies in each square."""
    return rounded(SP.hex_grid(_outlines(spark, folder), RES), 4)


def cell_outline(spark, folder):
    """Corner coordinates, resolution and area of the cells covered by each square."""
    cells = SP.hex_grid(_outlines(spark, folder), RES)
    q, r = H.coordinates_of(F.col("cell_id"))
    ring = H.outline(q, r, RES)
    box = G.bounds(ring)
    return rounded(cells.select(
        "feature_id", "cell_id", H.resolution_of(F.col("cell_id")).alias("resolution"),
        box.xmin.alias("xmin"), box.ymin.alias("ymin"), box.xmax.alias("xmax"),
        box.ymax.alias("ymax"), G.area(ring).alias("area_m2")), 4)


def bbox_filter(spark, folder):
    """Buildings whose box overlaps a window, edges included."""
    c = TB.polygons(spark, folder)
    boxed = c.withColumn("bbox", G.bounds(F.col("rings")))
    return boxed.where(G.overlaps_box(F.col("bbox"), 500.0, 500.0, 1500.0, 1200.0)).select(
        "feature_id", F.col("bbox.xmin").alias("xmin"), F.col("bbox.ymax").alias("ymax"))


def polygon_filter(spark, folder):
    """Squares that meet the L-shaped boundary."""
    squares = TB.polygons(spark, folder, 10).select(
        "feature_id", F.lit("Polygon").alias("geom_type"), "rings")
    return SP.filter_intersecting(squares, TB.boundary(spark, folder)).select("feature_id")


def line_filter(spark, folder):
    """Roads that meet the L-shaped boundary."""
    lines = TB.nested_roads(spark, folder).select(
        "feature_id", F.lit("LineString").alias("geom_type"), "rings")
    return SP.filter_intersecting(lines, TB.boundary(spark, folder)).select("feature_id")


def boundary_filter_slit(spark, folder):
    """Points, roads and squares that meet an outline of two parts with a slit and a hole."""
    return SP.filter_intersecting(TB.mixed_features(spark, folder), TB.slit_boundary(spark, folder)).select("feature_id")


def utm_project(spark, folder):
    """Orders as lon/lat points: zone code, easting, northing and the way back."""
    key = F.col("o_orderkey")
    lon = (key * 7919 % 360000) / 1000.0 - 180.0
    lat = (key * 104729 % 160000) / 1000.0 - 80.0
    placed = TB.table(spark, folder, "orders").select(key, lon.alias("lon"), lat.alias("lat"))
    u = P.to_utm(F.col("lon"), F.col("lat"), P.utm_zone(F.col("lon")), F.col("lat") < 0)
    return rounded(placed.withColumn("u", u).select(
        "o_orderkey", P.utm_code(F.col("lon"), F.col("lat")).alias("crs"),
        F.col("u.x").alias("easting"), F.col("u.y").alias("northing")), 3)


def geometry_decode(spark, folder):
    """GeoJSON text of points, lines and polygons to rings; length, area and centroid of each."""
    key = F.col("p_partkey")
    x, y = TB.plane_x(key, 2000).cast("bigint"), TB.plane_y(key, 2000).cast("bigint")
    s = F.col("p_size").cast("bigint")
    pair = lambda a, b: F.concat(F.lit("["), a.cast("string"), F.lit(","), b.cast("string"), F.lit("]"))
    path = F.concat_ws(",", pair(x, y), pair(x, y + s), pair(x + s, y + s), pair(x + s, y))
    kind = F.when(key % 3 == 0, "Point").when(key % 3 == 1, "LineString").otherwise("Polygon")
    coords = (F.when(key % 3 == 0, pair(x, y)).when(key % 3 == 1, F.concat(F.lit("["), path, F.lit("]")))
              .otherwise(F.concat(F.lit("[["), path, F.lit(","), pair(x, y), F.lit("]]"))))
    text = F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), coords, F.lit("}"))
    shapes = (TB.table(spark, folder, "part").select(key, from_geojson(text).alias("g"))
              .select("p_partkey", "g.geom_type", "g.rings"))
    return _measures(shapes)


def geometry_decode_bytes(spark, folder):
    """The same shapes from well-known bytes."""
    key = F.col("p_partkey")
    x, y, s = TB.plane_x(key, 2000), TB.plane_y(key, 2000), F.col("p_size")
    corners = [G.point(x, y), G.point(x, y + s), G.point(x + s, y + s), G.point(x + s, y)]
    kind = F.when(key % 3 == 0, "Point").when(key % 3 == 1, "LineString").otherwise("Polygon")
    rings = F.array(F.when(key % 3 == 0, F.array(corners[0])).when(key % 3 == 1, F.array(*corners))
                    .otherwise(F.array(*corners, corners[0])))
    made = TB.table(spark, folder, "part").select(key, TB.to_wkb(kind, rings).alias("geometry"))
    return _measures(decode(made))


def _measures(shapes):
    """Area, length and centroid of decoded shapes."""
    c = G.any_centroid(F.col("rings"), F.col("geom_type"))
    polygon = F.col("geom_type") == "Polygon"
    return rounded(shapes.select(
        "p_partkey", "geom_type", F.when(polygon, G.area(F.col("rings"))).alias("area"),
        F.when(F.col("geom_type") == "LineString", G.length(F.col("rings"))).alias("length"),
        c.x.alias("cx"), c.y.alias("cy")), 4)


def _layers(spark, folder):
    return [road_layer(spark, folder), poi_layer(spark, folder), building_layer(spark, folder),
            landuse_layer(spark, folder), address_layer(spark, folder),
            infrastructure_layer(spark, folder), land_cover_layer(spark, folder),
            connector_layer(spark, folder), building_part_layer(spark, folder),
            division_layer(spark, folder), bathymetry_layer(spark, folder)]


def hex_features(spark, folder):
    """All eleven layers on the grid, the full raw table."""
    return FE.join_on_grid(grid(spark, folder), _layers(spark, folder))


HEADLINE = ["total_road_length_m", "poi_count_total", "building_count", "landuse_total_area_m2",
            "address_count_total", "infra_count_total", "landcover_total_area_m2",
            "connector_count_total", "building_part_count", "division_count", "bathymetry_area_m2"]


def hex_features_wide(spark, folder):
    """One column of every layer after the wide join."""
    return rounded(hex_features(spark, folder).select("cell_id", "cell_area_m2", *HEADLINE), 4)


def hex_ml_features(spark, folder):
    """Log and indicator columns of the wide table."""
    ml = FE.ml_features(hex_features(spark, folder))
    logs = ["total_road_length_m", "poi_count_total", "poi_count_BUILDING", "building_count_house",
            "building_area_house_m2", "landuse_area_forest_m2", "connector_density_per_km2",
            "building_part_avg_height_m", "unique_road_names"]
    return rounded(ml.select("cell_id", *[f"log1p_{c}" for c in logs], "has_bridge", "has_tunnel",
                             "has_link", "has_under_construction", "has_access_restrictions",
                             "has_foot_restriction", "has_bicycle_restriction",
                             "has_hgv_restriction"))


def hex_ml_schema(spark, folder):
    """Number of raw, log and indicator columns next to the row count of the wide table."""
    raw = hex_features(spark, folder)
    ml = FE.ml_features(raw)
    logs = [c for c in ml.columns if c.startswith("log1p_")]
    flags = len(ml.columns) - len(raw.columns) - len(logs)
    return raw.agg(F.count(F.lit(1)).alias("hexes")).select(
        "hexes", F.lit(len(raw.columns)).alias("raw_columns"),
        F.lit(len(logs)).alias("log_columns"), F.lit(flags).alias("indicator_columns"))


def schema_violations(spark, folder):
    """A building table checked against the declared schema: nulls and missing columns."""
    c = TB.buildings(spark, folder)
    broken = c.select(
        F.when(F.col("feature_id") % 10 != 0, F.col("feature_id").cast("string")).alias("feature_id"),
        "building_class", "height", F.lit("Polygon").alias("geom_type"),
        F.when(F.col("feature_id") % 4 != 0, F.col("rings")).alias("rings"))
    return S.violations(broken, S.BUILDINGS)


def layer_manifest(spark, folder):
    """Row counts per layer."""
    return lake.row_counts({
        "roads": TB.table(spark, folder, "lineitem"), "pois": TB.table(spark, folder, "customer"),
        "buildings": TB.table(spark, folder, "part"),
        "addresses": TB.table(spark, folder, "supplier"),
        "connectors": TB.table(spark, folder, "orders"),
        "bathymetry": TB.bathymetry(spark, folder)})


def satellite_means(spark, folder):
    return FE.pixel_means(at_points(TB.pixels(spark, folder)), 64)


def satellite_hex_mean(spark, folder):
    return rounded(satellite_means(spark, folder), 6)


def satellite_stream_mean(spark, folder):
    """The same means from a stream with saved partial sums; vectors land slice by slice, each call goes on."""
    home = scratch(spark, "pixels")
    replay(TB.table(spark, folder, "embeddings"), F.col("vec_id").cast("long"),
           lambda landed: PS.add_sums(at_points(TB.pixel_columns(landed)), 64, home), name="pixels")
    return rounded(PS.saved_means(spark, 64, home), 6)


def satellite_summary(spark, folder):
    return rounded(FE.pixel_summary(satellite_means(spark, folder)))


def merge_features_embeddings(spark, folder):
    """Connector features with embeddings; unmatched cells keep null bands."""
    merged = FE.merge_embeddings(connector_layer(spark, folder), satellite_means(spark, folder))
    return rounded(merged.drop("connector_density_per_km2"), 6)


def merge_match_counts(spark, folder):
    return FE.match_counts(connector_layer(spark, folder), satellite_means(spark, folder))


def pixel_grid(spark, folder):
    """Pixel centres over the bounds of every supplier square of 30 m."""
    key, side = F.col("s_suppkey"), TB.SIDE["supplier"]
    boxes = TB.table(spark, folder, "supplier").select(
        key.alias("tile"), TB.plane_x(key, side).alias("xmin"), TB.plane_y(key, side).alias("ymin"))
    boxes = boxes.select("tile", "xmin", "ymin", (F.col("xmin") + 30.0).alias("xmax"),
                         (F.col("ymin") + 30.0).alias("ymax"))
    return rounded(PX.pixel_centres(boxes, 10.0), 6)


QUERIES = {f.__name__: f for f in (
    poi_hex_features, address_hex, infra_hex, connector_density, road_hex_core, road_class_lengths,
    road_speed_weighted, road_flag_fractions, road_surface_width, road_names_routes,
    road_attributes, building_hex, building_part_hex, landuse_hex, landcover_fraction,
    bathymetry_hex, division_counts, hex_grid, cell_outline, bbox_filter, polygon_filter,
    line_filter, boundary_filter_slit, utm_project, geometry_decode, geometry_decode_bytes, hex_features_wide, hex_ml_features, hex_ml_schema,
    schema_violations, layer_manifest, satellite_hex_mean,
    satellite_stream_mean, satellite_summary,
    merge_features_embeddings, merge_match_counts, pixel_grid)}
