"""Feeds, sinks and streams on small landed files."""

import datetime as dt
import json

from pyspark.sql import functions as F

from hexloom.operators import incidents as I
from hexloom.plans import incident_queries as Q
from hexloom.sinks import writers as W
from hexloom.sources import snapshots as SN
from hexloom.streaming import incidents as SI

SYDNEY = [151.2, -33.8]


def feature_a(native, kind="Unplanned", category="Crash", at=SYDNEY, **more):
    return {"id": native, "geometry": {"type": "Point", "coordinates": at},
            "properties": {"incidentKind": kind, "mainCategory": category, "created": 1730435174000,
                           "lastUpdated": 1730435174000, **more}}


def land(folder, source, stamp, features):
    day = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}"
    target = folder / f"source={source}" / f"dt={day}" / f"hour={stamp[9:11]}"
    target.mkdir(parents=True, exist_ok=True)
    (target / f"{stamp}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))


def test_first_coordinate(spark):
    cases = [('{"type":"Point","coordinates":[1.5,-2]}', (1.5, -2.0)),
             ('{"type":"MultiPolygon","coordinates":[[[[3,4],[5,6]]]]}', (3.0, 4.0)),
             ('{"type":"GeometryCollection","geometries":[{"type":"Point"},{"type":"LineString","coordinates":[[7,8],[9,9]]}]}', (7.0, 8.0)),
             ('{"type":"Circle","coordinates":[1,2]}', None), ('null', None), ('{"type":"Point","coordinates":[]}', None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "t string")
    got = df.select(SN.first_coordinate(F.from_json("t", SN.GEOMETRY)).alias("p")).collect()
    assert [None if r.p is None else (r.p.lon, r.p.lat) for r in got] == [want for _, want in cases]


def test_feed_a_filters_and_fields(spark, tmp_path):
    edge = [150.5, -34.2]
    land(tmp_path, "tfnsw", "20260416T080000Z", [
        feature_a(1, isMajor=True, end=1730435174000, hideEndDate=True,
                  roads=[{"mainStreet": " M4 ", "suburb": "null", "impactedLanes": [{"n": 1}, {"n": 2}]}]),
        feature_a(2, kind="Planned"), feature_a(3, category="Special"), feature_a(4, at=[0.0, 0.0]),
        feature_a(5, category="flood", at=edge), {"id": 6, "geometry": None, "properties": None}])
    rows = {r.incident_id: r for r in I.normalise_a(SN.features(SN.read_snapshots(spark, str(tmp_path)))).collect()}
    assert set(rows) == {"tfnsw:1", "tfnsw:5"}
    first = rows["tfnsw:1"]
    assert (first.severity, first.road_name, first.suburb, first.lanes_affected, first.end_time) == (
        "major", "M4", None, 2, None)
    assert first.collected_at == dt.datetime(2026, 4, 16, 8)
    assert json.loads(first.raw_payload)["id"] == 1
    assert rows["tfnsw:5"].event_type == "flood"


def test_feed_b_later_list_wins(spark):
    def feature(text, kind="Crash"):
        return json.dumps({"geometry": {"type": "Point", "coordinates": [153.0, -27.5]},
                           "properties": {"id": 7, "event_type": kind, "description": text}})
    now = dt.datetime(2026, 4, 16)
    df = spark.createDataFrame([(now, 0, 0, feature("active")), (now, 1, 0, feature("recent"))],
                               "collected_at timestamp, list_no int, position int, feature string")
    assert [r.description for r in I.normalise_b(df).collect()] == ["recent"]
    hidden = spark.createDataFrame([(now, 0, 0, feature("active")), (now, 1, 0, feature("x", "Roadworks"))], df.schema)
    assert I.normalise_b(hidden).count() == 0


def test_no_features_gives_full_schema(spark, tmp_path):
    land(tmp_path, "tfnsw", "20260416T080000Z", [])
    out = I.normalise_a(SN.features(SN.read_snapshots(spark, str(tmp_path))))
    assert out.count() == 0 and len(out.columns) == 25


def test_backfill_windows(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1), dt.datetime(2026, 7, 1))],
                               "start_time timestamp, end_time timestamp")
    got = [(r.window_start.date().isoformat(), r.window_end.date().isoformat())
           for r in I.backfill_windows(df).orderBy("window_start").collect()]
    assert got == [("2026-01-01", "2026-04-01"), ("2026-04-01", "2026-06-30"), ("2026-06-30", "2026-07-01")]


def test_backfill_sink(spark, tmp_path):
    start = dt.datetime(2026, 1, 1)
    docs = spark.createDataFrame([('{"features":[]}', start, start + dt.timedelta(days=90))],
                                 "value string, window_start timestamp, window_end timestamp")
    W.write_backfill(docs, str(tmp_path / "out"))
    row = spark.read.text(str(tmp_path / "out")).first()
    assert (row.value, row.source, str(row.dt)) == ('{"features":[]}', "tfnsw-historical", "2026-01-01")


def test_a_window_fetched_again_replaces_itself(spark, tmp_path):
    start = dt.datetime(2026, 1, 1)
    docs = lambda text, *days: spark.createDataFrame(
        [(text, start + dt.timedelta(days=d), start + dt.timedelta(days=d + 90)) for d in days],
        "value string, window_start timestamp, window_end timestamp")
    out = str(tmp_path / "out")
    W.write_backfill(docs("a", 0, 90), out)
    for _ in range(2):
        W.write_backfill(docs("b", 90), out)
    assert sorted((r.value, str(r.dt)) for r in spark.read.text(out).collect()) == [("a", "2026-01-01"), ("b", "2026-04-01")]


def test_poll_log_tells_what_each_feed_did(spark, tmp_path):
    """One line per feed and poll; the analysis reads what the sink wrote."""
    inbox, raw, done, state, log = (str(tmp_path / n) for n in ("inbox", "raw", "processed", "state", "log"))
    box = tmp_path / "inbox"
    for source in I.NORMALISERS:
        (box / f"source={source}").mkdir(parents=True)
    land(box, "tfnsw", "20260416T080000Z", [feature_a(1), feature_a(2)])
    land(box, "qldtraffic", "20260416T080000Z", [])
    land(box, "dtpvic", "20260416T080000Z", [])
    outcome = SI.collect_all(spark, inbox, raw, done, state, poll_log=log)
    assert outcome == dict.fromkeys(I.NORMALISERS, "ok")
    land(box, "tfnsw", "20260416T080500Z", [feature_a(1)])
    SI.collect_all(spark, inbox, raw, done, state, poll_log=log)
    lines = [json.loads(r.value) for r in spark.read.text(log).collect()]
    own = sorted((x["msg"], x.get("raw_features"), x.get("normalized_records")) for x in lines if x["source"] == "tfnsw")
    assert own == [("poll_source_ok", 1, 1), ("poll_source_ok", 2, 2)]
    counted = I.poll_outcomes(spark.read.text(log), F.current_timestamp() + F.expr("INTERVAL 1 MINUTE")).collect()
    assert {r.msg: r.n for r in counted} == {"poll_source_ok": len(lines)}


def test_poll_log_of_a_failing_feed(spark, tmp_path):
    inbox, done, state, log = (str(tmp_path / n) for n in ("inbox", "processed", "state", "log"))
    box = tmp_path / "inbox"
    for source in I.NORMALISERS:
        (box / f"source={source}").mkdir(parents=True)
        land(box, source, "20260416T080000Z", [])
    (tmp_path / "raw").write_text("a file where the folder of raw answers should be")
    outcome = SI.collect_all(spark, inbox, str(tmp_path / "raw"), done, state, poll_log=log)
    assert outcome == dict.fromkeys(I.NORMALISERS, "failed")
    lines = [json.loads(r.value) for r in spark.read.text(log).collect()]
    assert sorted(x["source"] for x in lines) == sorted(I.NORMALISERS)
    assert all(x["msg"] == "poll_source_failed" and x["level"] == "ERROR" and x["err"] for x in lines)


def test_collect_all_lands_both_zones_and_resumes(spark, tmp_path):
    inbox, raw, done, state = (str(tmp_path / n) for n in ("inbox", "raw", "processed", "state"))
    box = tmp_path / "inbox"
    for source in I.NORMALISERS:
        (box / f"source={source}").mkdir(parents=True)
    land(box, "tfnsw", "20260416T080000Z", [feature_a(1), feature_a(2)])
    assert SI.collect_all(spark, inbox, raw, done, state) == dict.fromkeys(I.NORMALISERS, "ok")
    land(box, "tfnsw", "20260416T080500Z", [feature_a(1)])
    SI.collect_all(spark, inbox, raw, done, state)
    found = SN.read_incidents(spark, done, "2026-04-01", "2026-04-30")
    assert found.count() == 3
    assert {(str(r.dt), r.city, r.source) for r in found.select("dt", "city", "source").collect()} == {
        ("2026-04-16", "sydney", "tfnsw")}
    assert SN.read_incidents(spark, done, "2026-05-01").count() == 0
    assert spark.read.text(raw).count() == 2
    assert I.latest_incidents(found).count() == 2
    counts = I.incident_counts(found).collect()
    assert [(r.city, r.event_type, r.n) for r in counts] == [("sydney", "crash", 3)]
    SN.register_incidents(spark, "incident_table", done)
    assert spark.table("incident_table").where("dt = '2026-04-16' AND source = 'tfnsw'").count() == 3
    spark.sql("DROP TABLE incident_table")


def test_same_poll_twice_changes_nothing(spark, tmp_path):
    land(tmp_path / "in", "tfnsw", "20260416T080000Z", [feature_a(1)])
    rows = I.normalise_a(SN.features(SN.read_snapshots(spark, str(tmp_path / "in"))))
    out = str(tmp_path / "out")
    for _ in range(2):
        W.write_incidents(rows, out)
    assert spark.read.parquet(out).count() == 1


def test_latest_version_is_cut_before_the_exchange(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("incident_id"),
        F.lit("s").alias("source"), F.timestamp_seconds("id").alias("last_updated"),
        F.timestamp_seconds("id").alias("collected_at"), F.col("id").cast("string").alias("raw_payload"))
    latest = I.latest_incidents(df)
    plan = latest._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert latest.where("incident_id = 'hot'").first().raw_payload == "999"
    assert latest.count() == 1 + 666


OBSERVED = "incident_id string, last_updated timestamp, collected_at timestamp, ended boolean"


def observations(spark, folder, batches):
    """One file per micro-batch; each entry is (incident, hour of sighting)."""
    base = dt.datetime(2026, 1, 1)
    for i, batch in enumerate(batches):
        rows = [(k, base, base + dt.timedelta(hours=h), False) for k, h in batch]
        spark.createDataFrame(rows, OBSERVED).coalesce(1).write.parquet(f"{folder}/{i:03d}")
    return (spark.readStream.schema(OBSERVED).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).parquet(str(folder)))


def run(spark, stream, tmp_path, mode="append"):
    out = str(tmp_path / "out")
    SI.run_to_end(stream, mode, SI.append_batches(out), str(tmp_path / "state"))
    return spark.read.parquet(out)


def test_long_delay_emits_an_unchanged_incident_once(spark, tmp_path):
    batches = [[("a", h)] for h in range(8)]
    stream = SI.deduplicated(observations(spark, tmp_path / "in", batches), "2 days")
    assert run(spark, stream, tmp_path).count() == 1


def test_timer_closes_after_quiet_time_only(spark, tmp_path):
    batches = [[("a", 0), ("b", 0)], [("a", 1)], [("a", 2)], [("c", 9)], [("c", 10)]]
    stream = SI.closed_incidents(observations(spark, tmp_path / "in", batches), "1 minute", 90)
    got = {r.incident_id: (r.first_seen.hour, r.last_seen.hour, r.sightings) for r in run(spark, stream, tmp_path).collect()}
    assert got == {"a": (0, 2, 3), "b": (0, 0, 1)}


def test_closings_do_not_depend_on_the_batches(spark, tmp_path):
    seen = [("a", 0), ("b", 1), ("a", 10), ("c", 20)]
    for name, batches in (("one", [seen]), ("many", [[s] for s in seen])):
        (tmp_path / name).mkdir()
        stream = SI.closed_incidents(observations(spark, tmp_path / name / "in", batches), "1 minute", 60)
        got = {(r.incident_id, r.first_seen.hour, r.last_seen.hour, r.sightings)
               for r in run(spark, stream, tmp_path / name).collect()}
        assert got == {("a", 0, 0, 1), ("b", 1, 1, 1), ("a", 10, 10, 1)}


def test_update_mode_rows_reduce_to_the_batch_result(spark, tmp_path):
    batches = [[("a", 0), ("b", 0)], [("a", 0), ("a", 5)], [("b", 6)]]
    source = observations(spark, tmp_path / "in", batches)
    run(spark, SI.sightings(source), tmp_path, "update")
    got = {tuple(r) for r in SI.newest_rows(spark, str(tmp_path / "out"), ["incident_id"]).collect()}
    static = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    assert got == {tuple(r) for r in I.lifecycle(static).collect()}


def test_a_late_sighting_opens_no_spell_again(spark, tmp_path):
    # a batch is late by the watermark that the batch before it began with
    batches = [[("a", 0)], [("b", 10)], [("b", 12)], [("a", 1)], [("c", 20)]]
    stream = SI.closed_incidents(observations(spark, tmp_path / "in", batches), "1 minute", 60)
    got = [(r.incident_id, r.first_seen.hour, r.sightings) for r in run(spark, stream, tmp_path).collect()]
    assert sorted(got) == [("a", 0, 1), ("b", 10, 1), ("b", 12, 1)]


def test_replay_gives_equal_rows_for_any_number_of_slices(spark):
    """One query that is started again for 1 and 7 slices, and one that goes on over 30 files, one a batch."""
    from hexloom.streaming.replay import replay, slice_bounds
    rows = (spark.read.parquet("/root/testdata/sf0.001/events.parquet")
            .withColumn("ts", F.col("ts").cast("timestamp")))
    make = {"dedup": (lambda s: SI.deduplicated(s, "1 day").select("incident_id", "last_updated"), "append"),
            "closed": (lambda s: SI.closed_incidents(s, "1 hour", 60), "append"),
            "hourly": (lambda s: SI.hourly_counts(s, "1 day", "source"), "update")}

    def result(kind, out):
        if kind == "hourly":
            return sorted(map(tuple, SI.newest_rows(spark, out, ["hour", "source"]).collect()))
        return sorted(map(tuple, spark.read.parquet(out).drop("batch").collect()))

    def restarted(kind, slices):
        transform, mode = make[kind]
        out, state, steps = SI.scratch(spark, "t-out"), SI.scratch(spark, "t-state"), []

        def step(landed):
            steps.append(SI.run_to_end(transform(Q.plain_incidents(landed)), mode, SI.append_batches(out), state))
        assert replay(rows, F.unix_micros("ts"), step, slices) == len(steps) == slices
        return result(kind, out)

    def in_one_go(kind, files):
        transform, mode = make[kind]
        inbox, out, state = (SI.scratch(spark, n) for n in ("t-in", "t-out", "t-state"))
        for low, high in slice_bounds(rows, F.unix_micros("ts"), files):
            part = rows.where((F.unix_micros("ts") >= low) & (F.unix_micros("ts") < high))
            part.coalesce(1).write.mode("append").parquet(inbox)
        landed = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        SI.run_to_end(transform(Q.plain_incidents(landed)), mode, SI.append_batches(out), state)
        return result(kind, out)
    for kind in make:
        assert restarted(kind, 1) == restarted(kind, 7) != []
    assert in_one_go("closed", 30) == restarted("closed", 1)


def test_replay_of_an_empty_table_and_of_rows_without_time(spark):
    from hexloom.streaming.replay import replay
    rows = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id long, at long")
    for df, spans, expected in ((rows, 3, [1, 2, 3]), (rows.limit(0), 1, []), (rows.where("at is null"), 1, [1])):
        out, state = SI.scratch(spark, "e-out"), SI.scratch(spark, "e-state")
        landed = replay(df, F.col("at"), lambda s: SI.run_to_end(s, "append", SI.append_batches(out), state), 3)
        assert landed == spans
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == expected
