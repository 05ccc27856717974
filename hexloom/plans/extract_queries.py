"""Queries of the extraction and satellite jobs over lake types in degrees with well-known bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom import schema as S
from hexloom.functions import geometry as G
from hexloom.functions.plan import once
from hexloom.plans import extract as EX
from hexloom.plans import lake_testbed as LT
from hexloom.plans import releases as RL
from hexloom.plans import testbed as TB
from hexloom.plans.geo_queries import rounded
from hexloom.sinks import writers as W
from hexloom.sources import lake
from hexloom.streaming.incidents import scratch

RES = TB.RES
BANDS = [f"A{i:02d}" for i in range(64)]


def job(spark: SparkSession, folder: str, layer: str) -> tuple[DataFrame | dict[str, DataFrame], EX.Zone]:
    """The result of one extraction job over its lake types and the zone it used."""
    run, kinds, _ = EX.JOBS[layer]
    outline = LT.outline(spark, folder)
    zone = EX.zone_of(outline)
    return run(*[LT.TYPES[k](spark, folder) for k in kinds], outline, zone), zone


def summed_up(layer: DataFrame, zone: EX.Zone) -> DataFrame:
    """Every column of a layer; its geometry as vertex count and bounds in metres."""
    kept = [c for c in layer.columns if c != "rings"]
    metres = RL.in_metres(layer.withColumn("vertices", F.size(F.flatten("rings"))), zone)
    boxed = metres.select(*kept, "vertices", once(G.bounds(F.col("rings"))).alias("_b"))
    sides = [F.round(f"_b.{n}", 2).alias(n) for n in ("xmin", "ymin", "xmax", "ymax")]
    values = [F.round("area_m2", 1).alias(c) if c == "area_m2" else F.col(c) for c in kept]
    return rounded(boxed.select(*values, "vertices", *sides))


def _layer(spark: SparkSession, folder: str, layer: str) -> DataFrame:
    return summed_up(*job(spark, folder, layer))


def extract_roads(spark, folder):
    """Roads without railways and points: nested attributes parsed."""
    return _layer(spark, folder, "roads")


def extract_pois(spark, folder):
    return _layer(spark, folder, "pois")


def extract_buildings(spark, folder):
    return _layer(spark, folder, "buildings")


def extract_landuse(spark, folder):
    """Land use, land and water as one layer."""
    return _layer(spark, folder, "landuse")


def extract_addresses(spark, folder):
    return _layer(spark, folder, "addresses")


def extract_infrastructure(spark, folder):
    return _layer(spark, folder, "infrastructure")


def extract_land_cover(spark, folder):
    return _layer(spark, folder, "land_cover")


def extract_connectors(spark, folder):
    return _layer(spark, folder, "connectors")


def extract_building_parts(spark, folder):
    return _layer(spark, folder, "building_parts")


def extract_divisions(spark, folder):
    """The three files of the layer under one another."""
    files, zone = job(spark, folder, "divisions")
    out = None
    for name, df in files.items():
        one = summed_up(df, zone).withColumn("file", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def extract_bathymetry(spark, folder):
    return _layer(spark, folder, "bathymetry")


def release_layers(spark, folder):
    """A lake on disk through the extraction job: rows of every saved file, read from its manifest."""
    base, out = scratch(spark, "lake"), scratch(spark, "layers")
    for kind, make in LT.TYPES.items():
        theme, _ = S.LAKE_TYPES[kind]
        make(spark, folder).write.parquet(f"{base}/release/r1/theme={theme}/type={kind}")
    status = EX.extract_all(spark, base, "r1", LT.outline(spark, folder), out)
    files = [f for layer, state in status.items() if state == "success" for f in EX.JOBS[layer][2]]
    counts = lake.row_counts({f: lake.read_layer(spark, out, f) for f in files})
    W.write_manifest(W.manifest(counts, "r1", RL.SCHEMA_VERSION, F.current_timestamp()), out)
    saved = spark.read.json(f"{out}/extraction_metadata").select("release", "row_counts.*")
    return saved.unpivot("release", files, "layer", "row_count")


def release_satellite(spark, folder):
    """Raster tiles in degrees averaged per cell, written and read as the table of the merge."""
    tiles = LT.raster_tiles(spark, folder, RES, BANDS)
    path = RL.aggregate_satellite(spark, tiles, BANDS, LT.outline(spark, folder), scratch(spark, "satellite"), RES)
    return rounded(spark.read.parquet(path))


def release_grid_degrees(spark, folder):
    """The grid of the outline with cell corners back in longitude and latitude."""
    outline = LT.outline(spark, folder)
    zone = EX.zone_of(outline)
    corners = F.posexplode(F.get("rings", F.lit(0))).alias("corner", "p")
    return rounded(RL.release_grid(outline, zone, RES).select("cell_id", corners).select(
        "cell_id", "corner", F.col("p.x").alias("lon"), F.col("p.y").alias("lat")), 8)


QUERIES = {f.__name__: f for f in (
    extract_roads, extract_pois, extract_buildings, extract_landuse, extract_addresses, extract_infrastructure,
    extract_land_cover, extract_connectors, extract_building_parts, extract_divisions, extract_bathymetry,
    release_layers, release_satellite, release_grid_degrees)}
