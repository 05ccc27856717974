"""Extraction steps that share one Python worker, bytes by columns, tasks by rows."""

import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hexloom import session
from hexloom.functions import geometry as G
from hexloom.functions import kernels as K
from hexloom.operators import incidents as I
from hexloom.operators import spatial as SP
from hexloom.plans import extract as EX
from hexloom.plans import testbed as TB
from hexloom.sources import geometry_decode as GD

CODES = {"Point": 1, "LineString": 2, "Polygon": 3}
NAN = float("nan")
SQUARE = [(151.0, -34.0), (151.1, -34.0), (151.1, -33.9), (151.0, -33.9), (151.0, -34.0)]
ITEMS = [("Point", [[(151.05, -33.95)]]), ("Point", [[(151.5, -33.95)]]), ("Point", [[(NAN, NAN)]]), ("Point", [[(NAN, -33.95)]]),
         ("LineString", [[(150.9, -33.95), (151.2, -33.95)]]), ("LineString", [[(150.9, -33.8), (151.05, -33.85)]]),
         ("Polygon", [[(151.02, -33.98), (151.02, -33.92), (151.08, -33.92), (151.02, -33.98)]]),
         ("Polygon", [[(150.0, -35.0), (152.0, -35.0), (152.0, -33.0), (150.0, -33.0), (150.0, -35.0)],
                      [(150.5, -34.5), (150.5, -34.4), (150.6, -34.4), (150.5, -34.5)]]),
         ("Polygon", [[(151.01, -33.99), (151.02, -33.98), (151.03, -33.97), (151.01, -33.99)]]), ("Polygon", [])]


def packed(kind, parts):
    blocks = [b"".join(struct.pack("<dd", *p) for p in part) for part in parts]
    head = struct.pack("<BI", 1, CODES[kind])
    if kind == "Point":
        return head + blocks[0]
    sized = [struct.pack("<I", len(part)) + block for part, block in zip(parts, blocks)]
    return head + (sized[0] if kind == "LineString" else struct.pack("<I", len(parts)) + b"".join(sized))


def rings_of(shapes):
    return pa.array([[[{"x": x, "y": y} for x, y in part] for part in parts] for parts in shapes],
                    pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def outline(spark):
    return spark.createDataFrame([([[{"x": x, "y": y} for x, y in SQUARE]],)], f"rings {G.RINGS_TYPE}")


def test_one_worker_decodes_tests_and_measures(spark):
    source = spark.createDataFrame([(str(i), bytearray(packed(*item))) for i, item in enumerate(ITEMS)] + [("n", None)],
                                   "id string, geometry binary")
    boundary, zone = outline(spark), EX.Zone(56, True)
    found = EX.within(source, boundary, zone)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    steps = SP.filter_intersecting(GD.decode(source).withColumnRenamed("id", "feature_id"), boundary)
    steps = steps.withColumn("_area_m2", G.area(K.to_utm_rings(F.col("rings"), zone.number, zone.south)))
    assert found.columns == steps.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, steps.collect()))
    assert {r.feature_id for r in found.collect()} == {"0", "4", "6", "7", "8"}
    assert EX.within(source, boundary).columns == ["feature_id", "geom_type", "rings"]


def test_areas_equal_those_of_columns(spark):
    rng = np.random.default_rng(5)
    shapes = [[[tuple(rng.uniform(0, 9, 2)) for _ in range(n)] for n in rng.integers(0, 8, rng.integers(0, 4))] for _ in range(300)]
    df = spark.createDataFrame(enumerate(rings_of(shapes).to_pylist()), f"i int, rings {G.RINGS_TYPE}")
    assert list(GD.ring_areas(rings_of(shapes))) == [r.a for r in df.orderBy("i").select(G.area("rings").alias("a")).collect()]


def test_bytes_are_written_and_read_by_columns():
    kinds, shapes = zip(*ITEMS)
    made = TB._wkb_batch(pa.array(kinds), rings_of(shapes))
    assert made.to_pylist() == [packed(*item) for item in ITEMS]
    assert TB._wkb_batch(pa.array(kinds).slice(4, 3), rings_of(shapes).slice(4, 3)).to_pylist() == made.to_pylist()[4:7]
    code = GD._plain_parts(made, shells=True)[0]
    assert code[6] == 3 and code[7] == 0  # a shell alone is read with its batch
    for raw, row in zip(made.to_pylist(), GD._decode_batch(made, shells=True).to_pylist()):
        kind, parts = GD._read_wkb(raw)
        assert row["geom_type"] == (kind if parts else None)
        assert repr([[(p["x"], p["y"]) for p in part] for part in row["rings"]]) == repr([list(map(tuple, p.tolist())) for p in parts])


def test_tasks_grow_in_number_with_the_rows(spark, monkeypatch, tmp_path):
    spark.range(9000).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    spread = TB.wide_table(spark, str(tmp_path), "t", "id")
    assert spread.rdd.getNumPartitions() == math.ceil(9000 / 500)
    assert spread.count() == 9000


def test_only_texts_are_sorted_for_the_last_version(spark):
    """The later list wins whatever it says, and texts with broken or missing members count as before."""
    rows = [(1, 0, '{"properties":{"id":"7","event_type":"Crash"},"geometry":{"type":"Point","coordinates":[153.0,-27.5]}}'),
            (1, 1, '{"properties":{"id":"7","event_type":"Roadworks"},"geometry":{"type":"Point","coordinates":[153.0,-27.5]}}'),
            (1, 0, '{"properties":{"id":8,"event_type":"Crash","duration":"x"},"geometry":{"type":"Point","coordinates":[153.0,-27.5]}}'),
            (1, 0, '{"properties":"none"}'), (1, 0, "{"), (1, 0, None)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "poll int, list_no int, feature string, position int")
    made = I.normalise_b(df.withColumn("collected_at", F.timestamp_seconds("poll")).drop("poll"))
    assert [r.incident_id for r in made.collect()] == ["qldtraffic:8"]
    plan = made._jdf.queryExecution().sparkPlan().toString()
    assert "road_summary" in plan and "road_summary" not in plan[plan.index("WindowGroupLimit"):]
