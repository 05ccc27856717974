"""A small lake through extraction, aggregation, embeddings and the release loop."""

import math

import pytest
from pyspark.sql import functions as F

from hexloom import schema as S
from hexloom.functions import geometry as G
from hexloom.plans import releases as HP
from hexloom.sources import lake
from hexloom.sources import pixels as PX
from tests.test_spatial import ring, wkb

LON, LAT = 151.20, -33.86
STEP = 0.001   # about 100 m


def at(dx, dy):
    return (LON + dx * STEP, LAT + dy * STEP)


def box(x0, y0, x1, y1):
    return [at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1), at(x0, y0)]


SHAPES = {
    "segment": [("LineString", [[at(1, 1), at(9, 6)]]), ("LineString", [[at(500, 0), at(501, 0)]])],
    "place": [("Point", [[at(2, 2)]]), ("Point", [[at(3, 3)]]), ("Point", [[at(900, 0)]])],
    "building": [("Polygon", [box(2, 2, 2.2, 2.2)])], "building_part": [("Polygon", [box(2, 2, 2.1, 2.1)])],
    "land_use": [("Polygon", [box(0, 0, 6, 6)])], "land": [("Polygon", [box(6, 6, 8, 8)])],
    "water": [("Polygon", [box(8, 0, 9, 3)])], "infrastructure": [("Point", [[at(4, 4)]])],
    "land_cover": [("Polygon", [box(1, 1, 9, 9)])], "bathymetry": [("Polygon", [box(7, 7, 9, 9)])],
    "address": [("Point", [[at(5, 5)]])], "connector": [("Point", [[at(1, 1)]]), ("Point", [[at(9, 6)]])],
    "division": [("Point", [[at(5, 4)]])], "division_area": [("Polygon", [box(0, 0, 10, 10)])],
    "division_boundary": [("LineString", [[at(0, 5), at(10, 5)]])],
}
VALUES = {
    "segment": {"subtype": "'road'", "class": "'primary'", "names": "named_struct('primary', 'Main St')"},
    "place": {"categories": "named_struct('primary', 'cafe', 'alternate', array('bar', 'shop'))"},
    "building": {"height": "12.5D"}, "land_use": {"class": "'park'"}, "water": {"is_salt": "true"},
    "land_cover": {"subtype": "'urban'"}, "division": {"admin_level": "4"}, "address": {"postcode": "'2000'"},
}


@pytest.fixture(scope="module")
def lake_folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    for kind, items in SHAPES.items():
        theme, columns = S.LAKE_TYPES[kind]
        full = spark.createDataFrame([], columns)
        rows = [(f"{kind}-{i}", bytearray(wkb(k, r)), {
            "xmin": min(p[0] for p in r[0]), "xmax": max(p[0] for p in r[0]),
            "ymin": min(p[1] for p in r[0]), "ymax": max(p[1] for p in r[0])}) for i, (k, r) in enumerate(items)]
        df = spark.createDataFrame(rows, f"id string, geometry binary, {S.BBOX}")
        given = VALUES.get(kind, {})
        df = df.select("id", "geometry", "bbox", *[
            F.expr(given.get(f.name, "null")).cast(f.dataType).alias(f.name) for f in full.schema.fields[3:]])
        df.write.parquet(f"{base}/release/r1/theme={theme}/type={kind}")
    return base


@pytest.fixture(scope="module")
def city(spark):
    return spark.createDataFrame([([ring(box(0, 0, 10, 10))],)], f"rings {G.RINGS_TYPE}")


@pytest.fixture(scope="module")
def released(spark, lake_folder, city, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    status = HP.run_releases(spark, lake_folder, ["r1", "missing"], city, out)
    return out, {r.release: r.status for r in status.collect()}


def test_release_status(spark, released, lake_folder, city):
    out, status = released
    assert status == {"r1": "success", "missing": "failed"}
    again = HP.run_releases(spark, lake_folder, ["r1"], city, out).first()
    assert again.status == "skipped"


def test_layers(spark, released):
    folder = f"{released[0]}/r1"
    roads = lake.read_layer(spark, folder, "roads").collect()
    assert [(r.feature_id, r.road_class, r.road_name, r.lanes) for r in roads] == [
        ("segment-0", "primary", "Main St", None)]
    assert lake.read_layer(spark, folder, "pois").count() == 2
    land = {r.land_type: r for r in lake.read_layer(spark, folder, "landuse").collect()}
    assert (land["land_use"].land_class, land["land"].land_class, land["water"].is_salt) == ("park", "unknown", True)
    metres = 111320 * STEP
    assert land["land_use"].area_m2 == pytest.approx(36 * metres * metres * math.cos(math.radians(LAT)), rel=0.01)
    assert not S.missing_columns(lake.read_layer(spark, folder, "buildings"), S.BUILDINGS)
    manifest = spark.read.json(f"{folder}/extraction_metadata").first()
    assert manifest.row_counts.pois == 2 and manifest.release == "r1"


def test_feature_table(spark, released):
    folder = f"{released[0]}/r1"
    raw = spark.read.parquet(HP.table_path(folder, "hex_features_raw", 9))
    ml = spark.read.parquet(HP.table_path(folder, "hex_features", 9))
    assert len(raw.columns) == 483 + 3 and len(ml.columns) == 942
    total = raw.agg(*[F.sum(c).alias(c) for c in (
        "poi_count_total", "poi_count_cafe", "building_count", "connector_count_total", "division_count",
        "bathymetry_area_m2", "landcover_area_urban_m2", "total_road_length_m")], F.count(F.lit(1)).alias("n"),
        F.max("division_area_count").alias("areas")).first()
    assert (total.poi_count_total, total.poi_count_cafe, total.building_count, total.division_count) == (2, 2, 1, 1)
    assert total.areas == 1 and total.n > 5
    cover = lake.read_layer(spark, folder, "land_cover").first().area_m2
    assert 0 < total.landcover_area_urban_m2 <= cover * 1.0001


def test_combined_table(spark, released, tmp_path):
    folder = f"{released[0]}/r1"
    features = HP.table_path(folder, "hex_features", 9)
    means = spark.read.parquet(features).select("cell_id", F.lit(1).alias("pixel_count"), F.lit(0.5).alias("A00")).limit(2)
    means.write.parquet(str(tmp_path / "means"))
    HP.combine(spark, features, str(tmp_path / "means"), str(tmp_path / "combined"))
    out = spark.read.parquet(str(tmp_path / "combined"))
    assert out.where("A00 IS NOT NULL").count() == 2 and out.count() == spark.read.parquet(features).count()


def test_box_filter_reaches_the_reader(spark, lake_folder):
    source = lake.read_lake(spark, lake_folder, "r1", "place")
    near = source.where(G.overlaps_box(F.col("bbox"), LON, LAT, LON + 1, LAT + 1)).select("id")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(bbox.xmin)" in plan and "PartitionFilters: [isnotnull(theme" in plan
    assert "confidence" not in plan.split("ReadSchema")[1]


def test_row_counts(spark):
    got = lake.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert {(r.layer, r.row_count) for r in got.collect()} == {("a", 3), ("b", 0)}


def test_tile_pixels_run_by_rows_from_the_top(spark):
    tiles = spark.createDataFrame([
        ("a", 0.0, 0.0, 30.0, 20.0, 3, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [7.0, 8.0, 9.0, 1.0, 2.0]),
        ("none", 0.0, 0.0, 30.0, 20.0, 3, [], []), ("null", 0.0, 0.0, 30.0, 20.0, 3, None, None)],
        "tile string, xmin double, ymin double, xmax double, ymax double, width int, p array<double>, q array<double>")
    got = [(r.x, r.y, r.band) for r in PX.tile_pixels(tiles, ["p", "q"], ["tile"]).orderBy("band").collect()]
    assert got == [(5.0, 15.0, [1.0, 7.0]), (15.0, 15.0, [2.0, 8.0]), (25.0, 15.0, [3.0, 9.0]),
                   (5.0, 5.0, [4.0, 1.0]), (15.0, 5.0, [5.0, 2.0]), (25.0, 5.0, [6.0, None])]


def test_satellite_step_to_combined_table(spark, released, city, tmp_path):
    """Tiles in degrees cover part of the grid; their cells carry means, the others null."""
    x, y = at(1, 1)
    nan = float("nan")
    tiles = spark.createDataFrame([(x, y, x + 8 * STEP, y + 8 * STEP, 2, [1.0, 3.0, nan, 3.0], [2.0, 4.0, 9.0, 4.0])],
                                  "xmin double, ymin double, xmax double, ymax double, width int, a array<double>, b array<double>")
    out = str(tmp_path)
    path = HP.aggregate_satellite(spark, tiles, ["a", "b"], city, out)
    means = spark.read.parquet(path)
    assert means.agg(F.sum("pixel_count")).first()[0] == 3
    assert {(r.A00, r.A01) for r in means.collect()} == {(1.0, 2.0), (3.0, 4.0)}
    # a finished table stays
    assert HP.aggregate_satellite(spark, tiles.limit(0), ["a", "b"], city, out) == path
    assert spark.read.parquet(path).count() == means.count()
    features = HP.table_path(f"{released[0]}/r1", "hex_features", 9)
    HP.combine(spark, features, path, f"{out}/combined")
    joined = spark.read.parquet(f"{out}/combined")
    assert joined.count() == spark.read.parquet(features).count()
    assert joined.where("A00 IS NOT NULL").count() == means.count()


def test_grid_outlines_are_degrees(spark, city):
    zone = HP.zone_of(city)
    cells = HP.release_grid(city, zone, 9).collect()
    corners = [p for r in cells for p in r.rings[0]]
    assert len(corners) == 6 * len(cells)
    assert all(abs(p.x - LON) < 0.02 and abs(p.y - LAT) < 0.02 for p in corners)
