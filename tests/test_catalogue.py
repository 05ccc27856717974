"""Catalogue statistics on hand-computed rows."""

import datetime as dt
import json

from pyspark.sql import functions as F

from hexloom import schema as S
from hexloom.operators import catalogue as C
from hexloom.sinks import writers as W
from hexloom.sources import catalogue as SC


def rows(spark, *items):
    base = dict.fromkeys(f.name for f in S.DATASET.fields)
    return spark.createDataFrame([tuple({**base, **i}.values()) for i in items], S.DATASET)


def test_growth_anchor_and_total(spark):
    day = lambda m, d: dt.datetime(2026, m, d)
    df = rows(spark, dict(id="a", name="a", size_bytes=1, last_modified=day(3, 31)),
              dict(id="b", name="b", size_bytes=2, last_modified=day(4, 10)))
    got = [(r.date, r.total_bytes) for r in C.growth_curve(df, 3).orderBy("date").collect()]
    assert got == [(day(2, 28), 0), (day(3, 31), 1), (day(4, 10), 3)]
    assert C.growth_curve(df.limit(0), 3).count() == 0


def test_growth_with_one_hot_date(spark):
    """A third of all rows share one date; the order within it is by id."""
    n = 600
    date = F.when(F.col("id") % 3 == 0, F.lit("2026-01-05")).otherwise(
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 30).cast("int")).cast("string"))
    df = spark.range(n).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("id"), F.lit("n").alias("name"),
                               F.lit("eta").alias("category"), (F.col("id") + 1).alias("size_bytes"),
                               date.cast("timestamp").alias("last_modified"))
    got = sorted((r.date, r.total_bytes) for r in C.growth_curve(df, 8).collect() if r.dataset_name)
    total, want = 0, []
    for r in sorted(df.collect(), key=lambda r: (r.last_modified, r.id)):
        total += r.size_bytes
        want.append((r.last_modified, total))
    assert got == sorted(want)


def test_summary_of_distinct_and_tied_values(spark):
    """Every value differs, or a third of all rows share one; the figures are exact."""
    import statistics

    import numpy as np

    from hexloom.operators import statistics as ST
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "top": 1.0, "low": 0.0, "odd": 0.333}
    rng = np.random.default_rng(3)
    for values in (rng.permutation(997) * 0.37, np.where(rng.random(800) < 0.35, 5.0, rng.normal(size=800)), np.array([4.0]),
                   np.array([1.0, 2.0])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(3)
        row = ST.summary(df, "v", shares, parts=7).first()
        assert row["count"] == len(values) and (row["min"], row["max"]) == (values.min(), values.max())
        for name, share in shares.items():
            assert abs(row[name] - np.quantile(values, share)) < 1e-9, name
        assert abs(row["mean"] - values.mean()) < 1e-9
        assert row["std"] is None if len(values) == 1 else abs(row["std"] - statistics.stdev(values.tolist())) < 1e-9
    empty = ST.summary(spark.createDataFrame([], "v double"), "v", shares).first()
    assert empty["count"] == 0 and all(empty[c] is None for c in ("mean", "std", "min", "q50", "max"))


def test_pair_impact(spark):
    df = rows(spark, *[dict(id=f"r{i}", pair_id="gps-data", stage="raw", size_bytes=b, file_count=1, format="CSV")
                       for i, b in enumerate((155759777928, 76042272152))],
              dict(id="p", pair_id="gps-data", stage="processed", size_bytes=37822531475, format=None),
              dict(id="x", pair_id="lonely", stage="raw", size_bytes=5))
    (row,) = C.pair_impact(df).collect()
    assert (row.label, row.raw_bytes, row.raw_files, row.processed_files) == ("Gps Data", 231802050080, 2, 0)
    assert round(row.size_reduction_pct, 1) == 83.7
    assert (row.raw_formats, row.processed_formats) == ("CSV", "Unknown")


def test_prefix_stats_and_defaults(spark):
    at = dt.datetime(2026, 1, 1)
    files = spark.createDataFrame(
        [("raw/gps/a.parquet", 5, at), ("raw/gps/x/b.PARQUET", 7, at), ("raw/gps/c.csv", 1, at),
         ("raw/gps/empty.csv", 0, at), ("raw/dump.tar.gz", 9, at), ("processed/w/a.b", 1, at), ("processed/w/a.a", 1, at)],
        "key string, size bigint, last_modified timestamp")
    doc = {"datasets": {"processed/w/": {"name": "Weather", "category": "weather", "stage": "raw", "bbox": [1, 2, 3, 4]}}}
    entries = SC.entries_of(spark.createDataFrame([(json.dumps(doc),)], "value string"))
    got = {r.id: r for r in C.build_datasets(C.prefix_stats(files), entries).collect()}
    assert set(got) == {"raw-gps", "raw-dump-tar-gz", "processed-w"}
    assert (got["raw-gps"].size_bytes, got["raw-gps"].file_count, got["raw-gps"].format) == (13, 3, "Parquet")
    assert got["raw-dump-tar-gz"].format == "GZ"
    assert (got["processed-w"].stage, got["processed-w"].format, got["processed-w"].bbox) == ("raw", "A", [1, 2, 3, 4])
    assert (got["raw-gps"].category, got["raw-gps"].region, got["raw-gps"].stage) == ("demographics", "Unknown", "raw")


def test_listing_and_document_round_trip(spark, tmp_path):
    (tmp_path / "raw" / "a").mkdir(parents=True)
    (tmp_path / "raw" / "a" / "f.csv").write_text("12345")
    files = SC.read_listing(spark, str(tmp_path))
    assert [(r.key, r.size) for r in files.collect()] == [("raw/a/f.csv", 5)]
    odd = tmp_path / "a+b"
    inner = odd / str(odd).lstrip("/")
    inner.mkdir(parents=True)
    (inner / "h.csv").write_text("1")
    assert [r.key for r in SC.read_listing(spark, str(odd)).collect()] == [f"{str(odd).lstrip('/')}/h.csv"]
    data = rows(spark, dict(id="a", size_bytes=1), dict(id="b", size_bytes=9))
    W.write_catalogue(data, str(tmp_path / "doc"), F.lit("now"))
    header = spark.read.json(str(tmp_path / "doc" / "header")).first()
    assert (header.dataset_count, header.total_size_bytes) == (2, 10)
    text = [json.loads(r.value)["id"] for r in spark.read.text(str(tmp_path / "doc" / "datasets")).collect()]
    assert text == ["b", "a"]
    moment = dt.datetime(2025, 1, 2, 3, 4, 5, 678901)
    odd = rows(spark, dict(id="line\nbreak", name='"', pair_id="", size_bytes=None, tags=["a", None], bbox=[1.5, -2.0, 3.0, 4.0],
                           temporal_range={"start": dt.date(2020, 1, 1), "end": None}, last_modified=moment), dict(id="z"))
    W.write_catalogue(odd, str(tmp_path / "odd"), F.lit("now"))
    again = SC.read_catalogue(spark, str(tmp_path / "odd")).select(*odd.columns)
    assert sorted(map(str, again.collect())) == sorted(map(str, odd.collect()))
    W.write_catalogue(odd.limit(0), str(tmp_path / "none"), F.lit("now"))
    assert SC.read_catalogue(spark, str(tmp_path / "none")).count() == 0
    record = {"datasets": [{"id": "z", "sizeBytes": 3, "pairId": "p", "temporalRange": {"start": "2020-01-01"}}]}
    back = SC.datasets_of(spark.createDataFrame([(json.dumps(record),)], "value string")).first()
    assert (back.id, back.size_bytes, back.pair_id, back.temporal_range.start) == ("z", 3, "p", dt.date(2020, 1, 1))


def test_entries_and_records_from_files(spark, tmp_path):
    (tmp_path / "entries.json").write_text(json.dumps({"datasets": {"raw/a/": {"name": "A", "pairId": "p"}}}, indent=2))
    (tmp_path / "records.json").write_text(json.dumps({"datasets": [{"id": "z"}, {"id": "y"}]}, indent=2))
    (row,) = SC.read_entries(spark, str(tmp_path / "entries.json")).collect()
    assert (row.prefix, row.name, row.pair_id) == ("raw/a/", "A", "p")
    assert SC.read_datasets(spark, str(tmp_path / "records.json")).count() == 2


def test_siblings_and_search(spark):
    df = rows(spark, dict(id="a", name="A", pair_id="p", category="eta", region="x", size_bytes=1),
              dict(id="b", name="B", pair_id="p", category="eta", region="x", size_bytes=1, tags=["Fast"]),
              dict(id="c", name="C", category="satellite", region="x", size_bytes=1))
    assert [r.id for r in C.siblings_of(df, "a").collect()] == ["b"]
    assert C.siblings_of(df, "c").count() == 0
    assert [r.id for r in C.search(df, "fast").collect()] == ["b"]
    assert C.search(df, "").count() == 3
    assert [r.id for r in C.palette_search(df, "satellite").collect()] == ["c"]
    assert [r.id for r in C.sort_datasets(df, "name").collect()] == ["c", "b", "a"]
    assert C.preview(df, 2).count() == 2


def test_kpis_of_nothing(spark):
    row = C.kpis(rows(spark)).first()
    assert (row.total_size_bytes, row.dataset_count, row.raw_total, row.last_updated) == (0, 0, 0, None)


def test_validation(spark):
    df = spark.createDataFrame([("1", None), (None, "x")], "feature_id string, category string")
    got = {(r.column_name, r.problem, r.null_count) for r in S.violations(df, S.POIS).collect()}
    assert {("feature_id", "null", 1), ("category", "null", 1), ("rings", "missing", 0)} <= got
    assert S.violations(df.limit(0), S.POIS).count() == 0


def test_manifest(spark):
    counts = spark.createDataFrame([("roads", 3), ("pois", 0)], "layer string, row_count bigint")
    row = W.manifest(counts, "r1", "1", F.lit("2026-01-01").cast("timestamp")).first()
    assert (row.layers_extracted, row.row_counts, row.extraction_timestamp) == (
        ["pois", "roads"], {"roads": 3, "pois": 0}, "2026-01-01T00:00:00Z")
