"""From saved layers to the feature tables of one release, and the loop over releases."""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.functions import geometry as G
from hexloom.functions import hexgrid as H
from hexloom.functions import kernels as K
from hexloom.functions import projection as P
from hexloom.functions.plan import once
from hexloom.operators import features as FE
from hexloom.operators import spatial as SP
from hexloom.plans.extract import ALL_LAYERS, Zone, extract_all, is_current, zone_of
from hexloom.sinks import writers as W
from hexloom.sources import lake
from hexloom.sources import pixels as PX

log = logging.getLogger(__name__)

MIN_COLUMNS = 50          # fewer columns mean a table from an older version
SCHEMA_VERSION = "1"


def in_metres(layer: DataFrame, zone: Zone) -> DataFrame:
    """Layer with its rings in UTM metres.

    ``once`` keeps lambda expressions that produced the rings out of the UDF's arguments, where
    Spark does not extract the UDF.
    """
    return (layer.withColumn("_g", once(F.col("rings")))
            .withColumn("rings", K.to_utm_rings(F.col("_g"), zone.number, zone.south)).drop("_g"))


def in_degrees(rings: Column, zone: Zone) -> Column:
    """Rings in UTM metres back in longitude and latitude."""
    back = lambda p: P.from_utm(p.x, p.y, zone.number, zone.south)
    return F.transform(rings, lambda ring: F.transform(ring, back))


def _first_points(layer: DataFrame, zone: Zone, res: int) -> DataFrame:
    """Cell of the first vertex, for point layers."""
    p = F.get(F.get("rings", F.lit(0)), F.lit(0))
    placed = in_metres(layer, zone).withColumn("_p", p)
    return SP.assign_points(placed, res, F.col("_p.x"), F.col("_p.y")).drop("_p", "rings")


def _centroids(layer: DataFrame, zone: Zone, res: int) -> DataFrame:
    """Cell of the centroid, for layers of any geometry type."""
    placed = in_metres(layer, zone).withColumn("_c", G.any_centroid(F.col("rings"), F.col("geom_type")))
    return SP.assign_points(placed, res, F.col("_c.x"), F.col("_c.y")).drop("_c", "rings")


def layer_features(spark: SparkSession, folder: str, layer: str, zone: Zone, res: int,
                   region: SP.Bounds) -> DataFrame:
    """One row per cell for one saved layer."""
    saved = lake.read_layer(spark, folder, layer)
    overlay = lambda df: SP.clip_polygons(in_metres(df, zone), res, region=region)
    if layer == "roads":
        return FE.road_features(SP.clip_lines(in_metres(saved, zone), res))
    if layer == "pois":
        return FE.poi_features(_first_points(saved, zone, res))
    if layer == "buildings":
        return FE.building_features(_centroids(saved, zone, res))
    if layer == "landuse":
        return FE.landuse_features(overlay(saved))
    if layer == "addresses":
        return FE.address_features(_first_points(saved, zone, res))
    if layer == "infrastructure":
        return FE.infrastructure_features(_centroids(saved, zone, res))
    if layer == "land_cover":
        return FE.land_cover_features(overlay(saved))
    if layer == "connectors":
        return FE.connector_features(_first_points(saved, zone, res), res)
    if layer == "building_parts":
        return FE.building_part_features(_centroids(saved, zone, res))
    if layer == "divisions":
        areas = lake.read_layer(spark, folder, "division_areas")
        lines = lake.read_layer(spark, folder, "division_boundaries")
        return FE.division_features(_centroids(saved, zone, res), overlay(areas),
                                    SP.clip_lines(in_metres(lines, zone), res))
    if layer == "bathymetry":
        sound = saved.where(G.is_repairable(F.col("rings"))).withColumn("rings", G.repair(F.col("rings")))
        return FE.bathymetry_features(overlay(sound), res)
    raise ValueError(f"unknown layer {layer}")


def release_grid(boundary: DataFrame, zone: Zone, res: int) -> DataFrame:
    """Grid of a boundary with cell outlines in longitude and latitude."""
    cells = SP.hex_grid(in_metres(boundary.select("rings"), zone), res)
    corners = in_degrees(H.outline(F.col("q"), F.col("r"), res), zone)
    return cells.select("cell_id", "cell_area_m2", corners.alias("rings"))


def table_path(folder: str, name: str, res: int) -> str:
    return f"{folder.rstrip('/')}/{name}_res{res:02d}.parquet"


def aggregate_layers(spark: SparkSession, folder: str, boundary: DataFrame, res: int = 9,
                     layers: Sequence[str] = ALL_LAYERS, resume: bool = True) -> str:
    """Write the raw and the transformed feature table; returns the path of the latter.

    The raw table is read back for the transforms, so the overlays run once.
    """
    target = table_path(folder, "hex_features", res)
    name = f"hex_features_res{res:02d}"
    if resume and lake.layer_exists(spark, folder, name):
        if len(lake.read_layer(spark, folder, name).columns) >= MIN_COLUMNS:
            return target
        log.warning("%s has too few columns, written again", target)
    zone = zone_of(boundary)
    metres = in_metres(boundary.select("rings"), zone)
    region = SP.bounds_of(metres)
    margin = 2 * H.edge(res)
    region = SP.Bounds(region.xmin - margin, region.ymin - margin, region.xmax + margin, region.ymax + margin)
    present = [n for n in layers if lake.layer_exists(spark, folder, n)]
    tables = [layer_features(spark, folder, n, zone, res, region) for n in present]
    wide = FE.join_on_grid(release_grid(boundary, zone, res), tables)
    raw = table_path(folder, "hex_features_raw", res)
    wide.write.mode("overwrite").parquet(raw)
    FE.ml_features(spark.read.parquet(raw)).write.mode("overwrite").parquet(target)
    return target


def satellite_means(tiles: DataFrame, bands: Sequence[str], zone: Zone, res: int) -> DataFrame:
    """Band means per cell from raster tiles in degrees: (cell_id, pixel_count, A00, ...)."""
    spots = PX.tile_pixels(tiles, list(bands), [])
    metres = spots.select("band", P.to_utm(F.col("x"), F.col("y"), zone.number, zone.south).alias("_p"))
    placed = SP.assign_points(metres, res, F.col("_p.x"), F.col("_p.y"))
    return FE.pixel_means(placed, len(bands))


def aggregate_satellite(spark: SparkSession, tiles: DataFrame, bands: Sequence[str], boundary: DataFrame,
                        folder: str, res: int = 9, resume: bool = True) -> str:
    """Write the band means of a release; returns their path. A finished table is kept with ``resume``."""
    target = table_path(folder, "satellite", res)
    if not (resume and lake.layer_exists(spark, folder, f"satellite_res{res:02d}")):
        satellite_means(tiles, bands, zone_of(boundary), res).write.mode("overwrite").parquet(target)
    return target


def combine(spark: SparkSession, features_path: str, means_path: str, out_path: str) -> None:
    """Feature table with the embedding means of its cells."""
    merged = FE.merge_embeddings(spark.read.parquet(features_path), spark.read.parquet(means_path))
    merged.write.mode("overwrite").parquet(out_path)


def run_releases(spark: SparkSession, base: str, releases: Sequence[str], boundary: DataFrame,
                 out: str, res: int = 9, layers: Sequence[str] = ALL_LAYERS) -> DataFrame:
    """Extract and aggregate each release: (release, status, elapsed_sec, layers_done).

    A release whose layers are all current is skipped; one that fails is not aggregated and does
    not stop the others.
    """
    rows = []
    for release in releases:
        started = time.monotonic()
        folder = f"{out.rstrip('/')}/{release}"
        try:
            current = all(is_current(spark, folder, n) for n in layers)
            done = extract_all(spark, base, release, boundary, folder, layers)
            good = [n for n, s in done.items() if s != "failed"]
            status = "skipped" if current else "success" if len(good) == len(done) else "failed"
            if status != "failed":
                counts = lake.row_counts({n: lake.read_layer(spark, folder, n) for n in good})
                W.write_manifest(W.manifest(counts, release, SCHEMA_VERSION, F.current_timestamp()), folder)
                aggregate_layers(spark, folder, boundary, res, good, resume=current)
        except Exception:  # the other releases go on
            log.exception("release %s failed", release)
            good, status = [], "failed"
        rows.append((release, status, round(time.monotonic() - started, 2), len(good)))
    return spark.createDataFrame(rows, "release string, status string, elapsed_sec double, layers_done int")
