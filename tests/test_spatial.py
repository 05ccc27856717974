"""Geometry, grid and overlays against exact values and brute force."""

import math
import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hexloom.functions import geometry as G
from hexloom.functions import hexgrid as H
from hexloom.functions import projection as P
from hexloom.operators import features as FE
from hexloom.operators import spatial as SP
from hexloom.sources import geometry_decode as GD
from hexloom.sources import pixels as PX

RES = 9
L_SHAPE = [(0, 0), (1200, 0), (1200, 400), (400, 400), (400, 800), (0, 800)]


def ring(points):
    return [{"x": float(a), "y": float(b)} for a, b in points]


def shapes(spark, *items):
    """Rows (feature_id, geom_type, rings) from (type, list of rings)."""
    rows = [(str(i), kind, [ring(r) for r in rings]) for i, (kind, rings) in enumerate(items)]
    return spark.createDataFrame(rows, f"feature_id string, geom_type string, rings {G.RINGS_TYPE}")


def test_area_centroid_length(spark):
    df = shapes(spark, ("Polygon", [L_SHAPE]), ("Polygon", [[(0, 0), (10, 0), (10, 10), (0, 10)],
                                                           [(2, 2), (2, 4), (4, 4), (4, 2)]]))
    rows = df.select(G.area(F.col("rings")), G.centroid(F.col("rings")), G.length(F.col("rings"))).collect()
    assert rows[0][0] == pytest.approx(640000)
    assert rows[1][0] == pytest.approx(96)
    assert rows[0][1].x == pytest.approx((480000 * 600 + 160000 * 200) / 640000)
    assert rows[1][1].x == pytest.approx((100 * 5 - 4 * 3) / 96)


def test_clip_keeps_total_area(spark):
    hole = [(100, 100), (100, 300), (300, 300), (300, 100)]
    df = shapes(spark, ("Polygon", [L_SHAPE]), ("Polygon", [L_SHAPE, hole]))
    total = {r.feature_id: r.s for r in SP.clip_polygons(df, RES).groupBy("feature_id").agg(
        F.sum("area_m2").alias("s")).collect()}
    assert total["0"] == pytest.approx(640000, abs=1e-6)
    assert total["1"] == pytest.approx(600000, abs=1e-6)


def test_large_polygon_is_split_and_whole(spark):
    """Covers far more blocks than stay in one task; the pieces add up and no cell repeats."""
    side = 60000.0
    df = shapes(spark, ("Polygon", [[(0, 0), (side, 0), (side, side), (0, side)]]))
    cut = SP.clip_polygons(df, RES)
    row = cut.agg(F.sum("area_m2"), F.count(F.lit(1)), F.count_distinct("cell_id")).first()
    assert row[0] == pytest.approx(side * side, rel=1e-9)
    assert row[1] == row[2]
    same = SP.clip_polygons(df, RES, spread=False)
    assert same.count() == row[1]


def test_lines_keep_total_length(spark):
    rng = random.Random(1)
    lines = [[(rng.uniform(-3000, 3000), rng.uniform(-3000, 3000)) for _ in range(rng.randint(2, 9))]
             for _ in range(60)]
    df = shapes(spark, *[("LineString", [pts]) for pts in lines])
    pieces = SP.clip_lines(df, RES)
    got = {r.feature_id: (r.s, r.n, r.d) for r in pieces.groupBy("feature_id").agg(
        F.sum("length_m").alias("s"), F.count(F.lit(1)).alias("n"),
        F.count_distinct("cell_id").alias("d")).collect()}
    for i, pts in enumerate(lines):
        want = sum(math.dist(a, b) for a, b in zip(pts, pts[1:]))
        assert got[str(i)][0] == pytest.approx(want, rel=1e-9)
        assert got[str(i)][1] == got[str(i)][2]


def test_points_fall_into_the_nearest_centre(spark):
    rng = random.Random(2)
    pts = [(rng.uniform(-5000, 5000), rng.uniform(-5000, 5000)) for _ in range(2000)]
    df = spark.createDataFrame(pts, "x double, y double")
    q, r = H.coordinates_of(H.cell_of(F.col("x"), F.col("y"), RES))
    cx, cy = H.centre(q, r, RES)
    far = df.select(F.max(F.sqrt((F.col("x") - cx) ** 2 + (F.col("y") - cy) ** 2))).first()[0]
    assert far <= H.edge(RES) + 1e-9


def _inside(points, x, y):
    odd = False
    for (x0, y0), (x1, y1) in zip(points, points[1:] + points[:1]):
        if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
            odd = not odd
    return odd


def test_grid_holds_the_cells_with_centre_inside(spark):
    grid = SP.hex_grid(shapes(spark, ("Polygon", [L_SHAPE])), RES).collect()
    e = H.edge(RES)
    want = {f"9:{q}:{r}" for q in range(-10, 15) for r in range(-5, 10)
            if _inside(L_SHAPE, (q + r / 2) * H.SQRT3 * e, 1.5 * e * r)}
    assert {g.cell_id for g in grid} == want


def test_outline_has_the_cell_area(spark):
    row = spark.range(1).select(G.area(H.outline(F.lit(3), F.lit(-2), RES))).first()
    assert row[0] == pytest.approx(H.true_cell_area(RES))


@pytest.mark.parametrize("limit", [200_000, 0])
def test_boundary_filter_against_brute_force(spark, monkeypatch, limit):
    """With the grid broadcast, and with the join by tile that larger outlines take."""
    monkeypatch.setattr(SP, "BROADCAST_VERTICES", limit)
    rng = random.Random(3)
    items = []
    for _ in range(150):
        x, y, s = rng.uniform(-300, 1500), rng.uniform(-300, 1200), rng.choice([2, 30, 200, 3000])
        items.append(("Point", [[(x, y)]]))
        items.append(("LineString", [[(x, y), (x + s, y + s / 3)]]))
        items.append(("Polygon", [[(x, y), (x + s, y), (x + s, y + s), (x, y + s)]]))
    df = shapes(spark, *items)
    boundary = shapes(spark, ("Polygon", [L_SHAPE])).select("rings")
    met = SP.filter_intersecting(df, boundary)
    assert ("SortMergeJoin" in met._jdf.queryExecution().sparkPlan().toString()) == (limit == 0)
    got = {int(r.feature_id) for r in met.collect()}
    boxes = ((0, 0, 1200, 400), (0, 0, 400, 800))

    def meets(kind, points):
        if kind == "Point":
            return _inside(L_SHAPE, *points[0])
        if kind == "Polygon":
            (x0, y0), (x1, y1) = points[0], points[2]
            return any(x0 <= b[2] and x1 >= b[0] and y0 <= b[3] and y1 >= b[1] for b in boxes)
        (x0, y0), (x1, y1) = points
        steps = [i / 20000 for i in range(20001)]
        return any(_inside(L_SHAPE, x0 + (x1 - x0) * t, y0 + (y1 - y0) * t) for t in steps)

    want = {i for i, (kind, rings) in enumerate(items) if meets(kind, rings[0])}
    assert got == want


def test_boundary_around_and_corner_touch(spark):
    boundary = shapes(spark, ("Polygon", [L_SHAPE])).select("rings")
    df = shapes(spark, ("Polygon", [[(-9000, -9000), (9000, -9000), (9000, 9000), (-9000, 9000)]]),
                ("Polygon", [[(1200, 400), (1300, 400), (1300, 500), (1200, 500)]]),
                ("Polygon", [[(500, 500), (900, 500), (900, 700), (500, 700)]]))
    assert sorted(r.feature_id for r in SP.filter_intersecting(df, boundary).collect()) == ["0", "1"]


def test_boundary_must_be_one_row(spark):
    two = shapes(spark, ("Polygon", [L_SHAPE]), ("Polygon", [L_SHAPE]))
    with pytest.raises(ValueError):
        SP.filter_intersecting(two, two)


def test_utm(spark):
    u = P.to_utm(F.lit(151.2153), F.lit(-33.8568), 56, True)
    df = spark.range(1).select(u.alias("u")).select("u", P.from_utm(F.col("u.x"), F.col("u.y"), 56, True).alias("b"))
    row = df.first()
    assert (row.u.x, row.u.y) == (pytest.approx(334900.570, abs=1e-3), pytest.approx(6252288.753, abs=1e-3))
    assert (row.b.x, row.b.y) == (pytest.approx(151.2153, abs=1e-8), pytest.approx(-33.8568, abs=1e-8))
    codes = spark.range(1).select(P.utm_code(F.lit(151.2), F.lit(-33.9)), P.utm_code(F.lit(180.0), F.lit(1.0))).first()
    assert tuple(codes) == ("EPSG:32756", "EPSG:32660")


def wkb(kind, rings):
    pack = lambda pts: struct.pack("<I", len(pts)) + b"".join(struct.pack("<dd", *p) for p in pts)
    head = lambda code: b"\x01" + struct.pack("<I", code)
    if kind == "Point":
        return head(1) + struct.pack("<dd", *rings[0][0])
    if kind == "LineString":
        return head(2) + pack(rings[0])
    if kind == "Polygon":
        return head(3) + struct.pack("<I", len(rings)) + b"".join(pack(r) for r in rings)
    if kind == "MultiPolygon":
        return head(6) + struct.pack("<I", len(rings)) + b"".join(wkb("Polygon", [r]) for r in rings)
    raise ValueError(kind)


def test_wkb_and_geojson_agree(spark):
    clockwise = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
    other = [(10.0, 0.0), (11.0, 0.0), (11.0, 1.0), (10.0, 0.0)]
    cases = [("Point", [[(1.0, 2.0)]], '[1,2]'), ("LineString", [[(1.0, 2.0), (3.0, 4.0)]], '[[1,2],[3,4]]'),
             ("Polygon", [clockwise, hole], str([[list(p) for p in r] for r in (clockwise, hole)])),
             ("MultiPolygon", [clockwise, other], str([[[list(p) for p in r]] for r in (clockwise, other)]))]
    rows = [(bytearray(wkb(k, r)), f'{{"type":"{k}","coordinates":{c}}}') for k, r, c in cases]
    df = spark.createDataFrame(rows, "b binary, t string")
    both = df.select(GD.from_wkb(F.col("b")).alias("b"), GD.from_geojson(F.col("t")).alias("t")).collect()
    for r in both:
        assert r.b == r.t
    assert spark.createDataFrame([(rows[2][0],)], "b binary").select(
        G.area(GD.from_wkb(F.col("b"))["rings"])).first()[0] == pytest.approx(15.0)
    empty = spark.createDataFrame([(None, None)], "b binary, t string")
    assert tuple(empty.select(GD.from_wkb(F.col("b"))["geom_type"], GD.from_geojson(F.col("t"))).first()) == (None, None)


def test_points_and_lines_are_read_by_columns(spark, monkeypatch):
    """Only other types, byte orders and dimensions are read one by one; each row is decoded once."""
    nan = float("nan")
    big = b"\x00" + struct.pack(">I", 1) + struct.pack(">dd", 7.0, 8.0)
    deep = b"\x01" + struct.pack("<I", 1001) + struct.pack("<ddd", 3.0, 4.0, 5.0)
    line = [(float(i), float(-i)) for i in range(5)]
    rows = [wkb("Point", [[(1.0, 2.0)]]), None, wkb("LineString", [line]), big, wkb("Point", [[(nan, nan)]]), deep, b"",
            wkb("LineString", [[]]), wkb("Polygon", [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)]]), wkb("LineString", [line[:2]]),
            b"\x01" + struct.pack("<I", 17), wkb("Point", [[(nan, 2.0)]])]
    slow, read = [], GD._read_wkb
    monkeypatch.setattr(GD, "_read_wkb", lambda raw: (slow.append(raw), read(raw))[1])
    for start in (0, 3):  # a slice of a batch has an offset
        got = GD._decode_batch(pa.array([b"x" * 40] * start + rows, pa.binary()).slice(start)).to_pylist()
        points = [g["rings"] and [[(p["x"], p["y"]) for p in part] for part in g["rings"]] for g in got]
        assert [g["geom_type"] for g in got] == ["Point", None, "LineString", "Point", None, "Point", None, None, "Polygon",
                                                 "LineString", None, "Point"]
        assert points[0] == [[(1.0, 2.0)]] and points[2] == [line] and points[3] == [[(7.0, 8.0)]]
        assert points[5] == [[(3.0, 4.0)]] and points[9] == [line[:2]] and points[8] == [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)]]
    assert set(slow) == {big, deep, rows[8], rows[10]}
    assert GD._decode_batch(pa.array([], pa.binary())).to_pylist() == []
    df = spark.createDataFrame([(i, bytearray(r) if r is not None else None) for i, r in enumerate(rows)], "id int, geometry binary")
    plan = GD.decode(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert [r.id for r in GD.decode(df).orderBy("id").collect()] == [0, 2, 3, 5, 8, 9, 11]


def test_repair_and_finite(spark):
    nan = float("nan")
    df = shapes(spark, ("Polygon", [[(0, 0), (0, 0), (5, 0), (5, 5), (0, 0)]]), ("Polygon", [[(0, 0), (nan, 1), (2, 2)]]),
                ("Polygon", [[(0, 0), (1, 1), (0, 0)]]))
    rows = df.select(F.size(G.repair(F.col("rings"))), G.is_repairable(F.col("rings"))).collect()
    assert [tuple(r) for r in rows] == [(1, True), (1, False), (0, False)]


def test_feature_schema_is_complete_for_empty_layers(spark):
    """All default vocabularies: 483 layer columns, 448 log companions, 8 indicators."""
    kinds = {"area_m2": "double", "height": "double", "length_m": "double", "num_floors": "double",
             "is_underground": "boolean", "admin_level": "int"}
    empty = lambda *names: spark.createDataFrame([], ", ".join(
        f"{n} {kinds.get(n, 'string')}" for n in ("cell_id", *names)))
    roads = spark.createDataFrame([], """cell_id string, length_m double, road_class string,
        speed_limit_kmh double, min_speed_kmh double, is_variable_speed boolean, is_bridge boolean,
        is_tunnel boolean, is_link boolean, is_under_construction boolean, road_surface string,
        width_m double, access_denied_foot boolean, access_denied_bicycle boolean,
        access_denied_hgv boolean, has_access_restriction boolean, subclass string, road_name string,
        route_count int, has_national_route boolean""")
    layers = [FE.road_features(roads), FE.poi_features(empty("category", "categories_alt")),
              FE.building_features(empty("building_class", "area_m2", "height")),
              FE.landuse_features(empty("land_class", "land_type", "area_m2")),
              FE.address_features(empty("postcode", "unit", "street")),
              FE.infrastructure_features(empty("infra_class")),
              FE.land_cover_features(empty("landcover_subtype", "area_m2")),
              FE.connector_features(empty(), RES),
              FE.building_part_features(empty("area_m2", "height", "num_floors", "is_underground")),
              FE.division_features(empty("admin_level"), empty(), empty("length_m")),
              FE.bathymetry_features(empty("area_m2"), RES)]
    assert [len(d.columns) - 1 for d in layers] == [65, 55, 155, 130, 4, 46, 14, 2, 5, 5, 2]
    grid = spark.createDataFrame([("9:0:0", 1.0)], "cell_id string, cell_area_m2 double")
    wide = FE.join_on_grid(grid, layers)
    ml = FE.ml_features(wide)
    assert len(wide.columns) == 483 + 2
    assert len([c for c in ml.columns if c.startswith("log1p_")]) == 448
    assert len(ml.columns) == 483 + 2 + 448 + 8
    row = wide.drop("cell_id", "cell_area_m2").first()
    assert set(row) == {0}


def test_weighted_speed(spark):
    pieces = spark.createDataFrame([("c", 100.0, 50.0), ("c", 300.0, 70.0), ("c", 100.0, None)],
                                   "cell_id string, length_m double, speed_limit_kmh double")
    row = FE.per_cell(pieces, {
        "m": FE.share("sum(speed_limit_kmh * length_m)", FE.sum_where("speed_limit_kmh IS NOT NULL", "length_m")),
        "c": FE.share(FE.sum_where("speed_limit_kmh IS NOT NULL", "length_m"), "sum(length_m)")}).first()
    assert (row.m, row.c) == (65.0, 0.8)


def test_pixel_rules(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", [1.0, 5.0]), ("a", [3.0, nan]), ("a", [nan, 9.0]), ("b", [nan, 1.0])],
                               "cell_id string, band array<float>")
    rows = FE.pixel_means(df, 2).collect()
    assert [(r.cell_id, r.pixel_count, r.A00) for r in rows] == [("a", 2, 2.0)]
    tile = spark.createDataFrame([(7, [1.0, 2.0], [3.0, 4.0])], "tile int, a array<float>, b array<float>")
    out = PX.unpack_tile(tile, ["a", "b"], ["tile"]).orderBy("pixel_index").collect()
    assert [(r.pixel_index, list(r.band)) for r in out] == [(0, [1.0, 3.0]), (1, [2.0, 4.0])]
    assert PX.pixel_step_degrees(9) == pytest.approx(43.5 / 111320)
    assert PX.pixel_scale_m(9) == 43.5 and PX.pixel_scale_m(11) == 10.0


def test_polygons_take_one_way_and_large_ones_many_tasks(spark, tmp_path):
    """One scan of the source; the pieces of one large polygon are dealt to many partitions, none is lost."""
    side = 400 * H.edge(RES)
    big = [(0.0, 0.0), (side, 0.0), (side, side / 2), (side / 2, side / 2), (side / 2, side), (0.0, side)]
    shapes(spark, ("Polygon", [big]), ("Polygon", [[(5.0, 5.0), (9.0, 5.0), (9.0, 9.0)]])).write.parquet(str(tmp_path / "p"))
    source = spark.read.parquet(str(tmp_path / "p"))
    cut = SP.clip_polygons(source, RES)
    assert cut._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("FileScan parquet") == 1
    blocks = SP.split_to_blocks(source.where("feature_id = '0'"), RES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        used = blocks.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert used == int(spark.conf.get("spark.sql.shuffle.partitions"))
    area = {r.feature_id: r.a for r in cut.groupBy("feature_id").agg(F.sum("area_m2").alias("a")).collect()}
    assert area["0"] == pytest.approx(0.75 * side * side, rel=1e-9) and area["1"] == pytest.approx(8.0)
    whole = SP.clip_polygons(source, RES, spread=False)
    key = lambda r: (r.feature_id, r.cell_id)
    for a, b in zip(sorted(cut.collect(), key=key), sorted(whole.collect(), key=key), strict=True):
        assert key(a) == key(b) and a.area_m2 == pytest.approx(b.area_m2, rel=1e-9)
