"""Extraction jobs: box filter, boundary filter, parsing and type filter per layer."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom import schema as S
from hexloom.functions import attributes as A
from hexloom.functions import geometry as G
from hexloom.functions import kernels as K
from hexloom.functions import projection as P
from hexloom.operators import spatial as SP
from hexloom.sinks.writers import write_layer
from hexloom.sources import lake
from hexloom.sources.geometry_decode import decode, from_wkb_within

log = logging.getLogger(__name__)

ALL_LAYERS = ("roads", "pois", "buildings", "landuse", "addresses", "infrastructure",
              "land_cover", "connectors", "building_parts", "divisions", "bathymetry")


@dataclass(frozen=True)
class Zone:
    """UTM zone for metres."""
    number: int
    south: bool


def zone_of(boundary: DataFrame, rings: str = "rings") -> Zone:
    """UTM zone at the centroid of a boundary; one row reaches the driver."""
    centre = G.centroid(F.col(rings))
    code = boundary.select(P.utm_code(centre.x, centre.y)).first()[0]
    return Zone(*P.zone_of_code(code))


def within(source: DataFrame, boundary: DataFrame, zone: Zone | None = None) -> DataFrame:
    """Features that meet the boundary: box test on the struct column, then the exact test.

    With a zone ``_area_m2`` holds their area. Bytes are decoded, tested and measured in one step, so a task
    has one Python worker for the three; other geometry columns and very large outlines take the steps one by one.
    """
    box, vertices = SP.measure_boundary(boundary)
    if "bbox" in source.columns:
        source = source.where(G.overlaps_box(F.col("bbox"), box.xmin, box.ymin, box.xmax, box.ymax))
    if "geometry" not in source.columns or source.schema["geometry"].dataType.typeName() != "binary" or vertices > SP.BROADCAST_VERTICES:
        found = SP.filter_intersecting(decode(source).withColumnRenamed("id", "feature_id").drop("bbox"), boundary)
        return found.withColumn("_area_m2", G.area(K.to_utm_rings(F.col("rings"), zone.number, zone.south))) if zone else found
    where = None if zone is None else (zone.number, zone.south)
    shape = from_wkb_within(F.col("geometry"), SP.shared_grid(boundary), (box.xmin, box.ymin, box.xmax, box.ymax), where)
    names = [c for c in source.columns if c not in ("geometry", "bbox")]
    found = source.withColumn("_g", shape).where(F.col("_g").isNotNull()).select(
        *names, "_g.geom_type", "_g.rings", *([F.col("_g.area_m2").alias("_area_m2")] if zone else []))
    return found.withColumnRenamed("id", "feature_id")


def _columns(df: DataFrame, flat: dict[str, Column], kinds: Sequence[str] | None) -> DataFrame:
    out = df.select("feature_id", *[c.alias(n) for n, c in flat.items()], "geom_type", "rings")
    out = out.where(F.size(F.flatten("rings")) > 0)
    return out.where(F.col("geom_type").isin(*kinds)) if kinds else out


def _class(name: str = "class") -> Column:
    return F.coalesce(F.col(name), F.lit("unknown"))


def _false(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def roads(segments: DataFrame, boundary: DataFrame, zone: Zone) -> DataFrame:
    found = within(segments.where(F.col("subtype") == "road"), boundary)
    return _columns(found, A.road_attributes(), G.LINE_KINDS)


def pois(places: DataFrame, boundary: DataFrame, zone: Zone) -> DataFrame:
    return _columns(within(places, boundary), {
        "name": F.col("names.primary"), "category": _class("categories.primary"),
        "confidence": F.col("confidence"),
        "categories_alt": A.joined_alternates(F.col("categories.alternate"))}, G.POINT_KINDS)


def buildings(source: DataFrame, boundary: DataFrame, zone: Zone) -> DataFrame:
    return _columns(within(source, boundary, zone), {
        "building_class": _class(), "height": A.number(F.col("height")),
        "num_floors": A.number(F.col("num_floors")), "area_m2": F.col("_area_m2"),
        "facade_material": F.col("facade_material"), "roof_material": F.col("roof_material"),
        "roof_shape": F.col("roof_shape"), "roof_height": A.number(F.col("roof_height")),
        "num_floors_underground": A.number(F.col("num_floors_underground")),
        "is_underground": _false("is_underground")}, G.POLYGON_KINDS)


def landuse(land_use: DataFrame, land: DataFrame, water: DataFrame, boundary: DataFrame,
            zone: Zone) -> DataFrame:
    """Three sources with different extra columns become one; absent ones are null or false."""
    none, no = F.lit(None).cast("string"), F.lit(False)

    def part(source, label, **extra):
        flat = {"land_type": F.lit(label), "land_class": _class(), "area_m2": F.col("_area_m2"),
                "land_subtype": none, "surface": none, "is_salt": no, "is_intermittent": no, **extra}
        return _columns(within(source, boundary, zone), flat, G.POLYGON_KINDS)

    return (part(land_use, "land_use", land_subtype=F.col("subtype"), surface=F.col("surface"))
            .unionByName(part(land, "land", surface=F.col("surface")))
            .unionByName(part(water, "water", is_salt=_false("is_salt"),
                              is_intermittent=_false("is_intermittent"))))


def addresses(source: DataFrame, boundary: DataFrame, zone: Zone) -> DataFrame:
    names = ("number", "street", "postcode", "unit", "country")
    return _columns(within(source, boundary), {n: F.col(n) for n in names}, None)


def infrastructure(source: DataFrame, boundary: DataFrame, zone: Zone) -> DataFrame:
    return _columns(within(source, boundary),
                    {"infra_class": _class(), "infra_subtype": F.col("subtype")}, None)


def land_cover(source: DataFrame, boundary: DataFrame, zone: Zone) -> DataFrame:
    return _columns(within(source, boundary, zone),
                    {"landcover_subtype": _class("subtype"), "area_m2": F.col("_area_m2")}, G.POLYGON_KINDS)


def connectors(source: DataFrame, boundary: DataFrame, zone: Zone) -> DataFrame:
    return _columns(within(source, boundary), {}, None)


def building_parts(source: DataFrame, boundary: DataFrame, zone: Zone) -> DataFrame:
    numbers = ("height", "num_floors", "num_floors_underground", "min_height")
    return _columns(within(source, boundary, zone), {
        "building_id": F.col("building_id"), **{n: A.number(F.col(n)) for n in numbers},
        "is_underground": _false("is_underground"), "area_m2": F.col("_area_m2")}, G.POLYGON_KINDS)


def divisions(points: DataFrame, areas: DataFrame, lines: DataFrame, boundary: DataFrame,
              zone: Zone) -> dict[str, DataFrame]:
    return {
        "divisions": _columns(within(points, boundary), {
            "division_subtype": F.col("subtype"), "division_class": F.col("class"),
            "admin_level": A.number(F.col("admin_level")),
            "population": A.number(F.col("population"))}, None),
        "division_areas": _columns(within(areas, boundary), {
            "division_subtype": F.col("subtype"), "area_class": F.col("class"),
            "admin_level": A.number(F.col("admin_level")), "is_land": F.col("is_land")},
            G.POLYGON_KINDS),
        "division_boundaries": _columns(within(lines, boundary), {}, None),
    }


def bathymetry(source: DataFrame, boundary: DataFrame, zone: Zone) -> DataFrame:
    return _columns(within(source, boundary, zone), {"area_m2": F.col("_area_m2")}, G.POLYGON_KINDS)


# Layer -> (job, lake types it reads, files it writes).
JOBS: dict[str, tuple[Callable, tuple[str, ...], tuple[str, ...]]] = {
    "roads": (roads, ("segment",), ("roads",)),
    "pois": (pois, ("place",), ("pois",)),
    "buildings": (buildings, ("building",), ("buildings",)),
    "landuse": (landuse, ("land_use", "land", "water"), ("landuse",)),
    "addresses": (addresses, ("address",), ("addresses",)),
    "infrastructure": (infrastructure, ("infrastructure",), ("infrastructure",)),
    "land_cover": (land_cover, ("land_cover",), ("land_cover",)),
    "connectors": (connectors, ("connector",), ("connectors",)),
    "building_parts": (building_parts, ("building_part",), ("building_parts",)),
    "divisions": (divisions, ("division", "division_area", "division_boundary"),
                  ("divisions", "division_areas", "division_boundaries")),
    "bathymetry": (bathymetry, ("bathymetry",), ("bathymetry",)),
}


def is_current(spark: SparkSession, folder: str, layer: str) -> bool:
    """All files are there, whole and readable, and for declared layers no column is missing."""
    files = JOBS[layer][2]
    if not all(lake.layer_exists(spark, folder, f) for f in files):
        return False
    try:
        saved = [lake.read_layer(spark, folder, f) for f in files]
    except (AnalysisException, Py4JJavaError):  # a folder that cannot be read is written anew
        log.warning("layer %s cannot be read", layer)
        return False
    declared = S.LAYER_SCHEMAS.get(layer)
    return declared is None or not S.missing_columns(saved[0], declared)


def extract_all(spark: SparkSession, base: str, release: str, boundary: DataFrame, folder: str,
                layers: Sequence[str] = ALL_LAYERS) -> dict[str, str]:
    """Write every layer that is not current; returns layer -> skipped, success or failed.

    A failing layer does not stop the others.
    """
    zone = zone_of(boundary)
    status: dict[str, str] = {}
    for layer in layers:
        if layer not in JOBS:
            continue
        job, kinds, files = JOBS[layer]
        try:
            if is_current(spark, folder, layer):
                status[layer] = "skipped"
                continue
            sources = [lake.read_lake(spark, base, release, k) for k in kinds]
            result = job(*sources, boundary, zone)
            outputs = result if isinstance(result, dict) else {files[0]: result}
            for name, df in outputs.items():
                write_layer(df, folder, name)
            if layer in S.LAYER_SCHEMAS:
                saved = lake.read_layer(spark, folder, layer)
                for row in S.violations(saved, S.LAYER_SCHEMAS[layer]).collect():  # a row per declared column at most
                    log.warning("%s: %s %s (%d)", layer, row.column_name, row.problem, row.null_count)
            status[layer] = "success"
        except Exception:  # one layer's input must not stop the rest
            log.exception("layer %s failed", layer)
            status[layer] = "failed"
    return status
