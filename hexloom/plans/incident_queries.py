"""Queries of the incident pipeline over the events table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.functions import values as V
from hexloom.operators import incidents as I
from hexloom.plans import testbed as TB
from hexloom.sources.snapshots import features
from hexloom.streaming import incidents as SI
from hexloom.streaming.replay import replay


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if f.dataType.typeName() == "timestamp" else F.col(f.name)
                       for f in df.schema.fields])


def events(spark: SparkSession, folder: str) -> DataFrame:
    e = TB.wide_table(spark, folder, "events", "event_id", "ts", "user_id", "event_type", "value")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def _place(box: tuple[float, float, float, float]) -> tuple[Column, Column]:
    """Longitude and latitude around a box, a margin of it outside."""
    key = F.col("user_id") * 31 + F.col("event_id")
    x, y = TB.plane_x(key, 5000), TB.plane_y(key, 5000)
    return (box[0] - 0.1 + x * ((box[2] - box[0] + 0.2) / 5000.0),
            box[1] - 0.1 + y * ((box[3] - box[1] + 0.2) / 5000.0))


def _geometry(lon: Column, lat: Column) -> Column:
    """GeoJSON of several types whose first vertex is the given place; some are null."""
    pair = F.concat(F.lit("["), lon.cast("string"), F.lit(","), lat.cast("string"), F.lit("]"))
    of = lambda kind, coords: F.concat(F.lit('{"type":"' + kind + '","coordinates":'), coords, F.lit("}"))
    line = of("LineString", F.concat(F.lit("["), pair, F.lit(",[0.0,0.0]]")))
    area = of("Polygon", F.concat(F.lit("[["), pair, F.lit(",[0.0,0.0],[1.0,1.0],"), pair, F.lit("]]")))
    mixed = F.concat(F.lit('{"type":"GeometryCollection","geometries":[{"type":"Point"},'), line, F.lit("]}"))
    k = F.col("event_id") % 5
    return (F.when(F.col("event_id") % 17 == 0, F.lit("null")).when(k == 0, of("Point", pair))
             .when(k == 1, line).when(k == 2, area).otherwise(mixed))


def _documents(df: DataFrame, box, properties: Column, native: Column | None) -> DataFrame:
    """One snapshot document per event."""
    lon, lat = _place(box)
    head = F.concat(F.lit('"id":'), native.cast("string"), F.lit(",")) if native is not None else F.lit("")
    text = F.concat(F.lit('{"type":"FeatureCollection","features":[{'), head, F.lit('"geometry":'),
                    _geometry(lon, lat), F.lit(',"properties":'), F.to_json(properties), F.lit("}]}"))
    return df.select(text.alias("value"), F.col("ts").alias("collected_at"), "event_id")


def _map(column: Column, words: dict[str, str]) -> Column:
    return TB.mapped(column, words)


def snapshots_a(spark, folder):
    e, et, eid = events(spark, folder), F.col("event_type"), F.col("event_id")
    ms = F.unix_millis("ts")
    text = lambda c: c.cast("string")
    lanes = F.when(eid % 4 > 0, F.sequence(F.lit(1), (eid % 4).cast("int"))).otherwise(
        F.array().cast("array<int>"))
    road = F.struct(F.concat(F.lit(" Main "), F.col("user_id")).alias("mainStreet"),
                    F.lit("  ").alias("crossStreet"),
                    F.when(eid % 2 == 0, "NULL").otherwise("Kensington").alias("suburb"),
                    F.when(eid % 3 == 0, "SYD_MET").alias("region"), lanes.alias("impactedLanes"))
    none = F.array().cast(road_type := "array<struct<linkText:string,linkURL:string>>")
    link = F.array(F.struct(F.lit("more").alias("linkText"),
                            F.concat(F.lit("http://l/"), eid).alias("linkURL"))).cast(road_type)
    p = F.struct(
        F.when(eid % 10 == 0, "Planned").otherwise("Unplanned").alias("incidentKind"),
        _map(et, {"click": "Crash", "view": "Breakdown", "error": "hazard",
                  "purchase": "Adverse Weather", "signup": "Special Event"}).alias("mainCategory"),
        F.when(eid % 3 == 0, " Car ").when(eid % 3 == 1, "null").alias("subCategoryA"),
        F.concat(F.lit("Event "), eid).alias("displayName"),
        F.when(eid % 7 == 0, "").otherwise("Take care").alias("headline"),
        (F.col("value") > 20).alias("isMajor"), (et == "purchase").alias("ended"),
        (eid % 2 == 0).alias("hideEndDate"), ms.alias("created"),
        F.when(eid % 4 == 0, F.lit(-1)).otherwise(ms - 60000).alias("start"),
        F.when(eid % 6 == 0, F.lit(0)).otherwise(ms + 3600000).alias("end"), ms.alias("lastUpdated"),
        F.when(eid % 5 != 0, F.array(F.lit("Police"), text(F.col("user_id")))).alias("attendingGroups"),
        F.when(eid % 3 == 0, link).otherwise(none).alias("webLinks"),
        F.when(eid % 3 != 2, F.lit("http://w/")).alias("weblinkUrl"),
        F.when(eid % 11 != 0, F.array(road)).alias("roads"))
    return _documents(e, I.FEED_A.box, p, eid % 3000)


def snapshots_b(spark, folder):
    """One poll per hour with two lists; the same id can occur several times in a poll."""
    e, eid = events(spark, folder), F.col("event_id")
    iso = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+10:00"))
    p = F.struct(
        (F.col("user_id") % 10).alias("id"),
        _map(F.col("event_type"), {"click": "Crash", "view": "Hazard", "error": "Flooding",
                                   "purchase": "Congestion", "signup": "Roadworks"}).alias("event_type"),
        F.when(eid % 3 == 0, "null").otherwise(" Multi ").alias("event_subtype"),
        F.when(eid % 4 == 0, "High").when(eid % 4 == 1, "Red Alert").when(eid % 4 == 2, "?").alias("event_priority"),
        F.concat(F.lit("Event "), eid).alias("description"),
        F.when(eid % 2 == 0, " ").otherwise("Slow down").alias("advice"), F.lit("Info").alias("information"),
        iso(F.col("ts")).alias("published"),
        F.when(eid % 5 != 0, iso(F.col("ts") + F.expr("INTERVAL 5 MINUTES"))).otherwise("junk").alias("last_updated"),
        F.when(eid % 2 == 0, "").otherwise("http://w").alias("web_link"), F.lit("http://u").alias("url"),
        F.struct(F.lit("Northbound").alias("direction")).alias("impact"),
        F.when(eid % 6 != 0, F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("start"),
                                      F.lit(None).cast("string").alias("end"))).alias("duration"),
        F.struct(F.concat(F.lit("Road "), F.col("user_id")).alias("road_name"), F.lit("Milton").alias("locality"),
                 F.lit("Brisbane").alias("local_government_area"), F.lit("null").alias("district"))
        .alias("road_summary"))
    docs = _documents(e, I.FEED_B.box, p, None)
    return docs.withColumn("list_no", F.col("event_id") % 2).withColumn(
        "collected_at", F.date_trunc("hour", "collected_at"))


def snapshots_c(spark, folder):
    e, eid = events(spark, folder), F.col("event_id")
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    subtypes = ["Stalled vehicle fire", "Rear-end COLLISION", "Road flooded", "Grass fire",
                "Animal on road", "Roadwork ahead", "Other"]
    p = F.struct(
        F.when(eid % 3 == 0, F.lit("")).when(eid % 3 == 1, eid.cast("string")).alias("id"),
        F.when(eid % 2 == 0, F.concat(F.lit("E"), eid)).alias("eventId"),
        F.concat(F.lit("I"), eid).alias("impactId"),
        F.when(eid % 9 == 0, "Crash").when(eid % 9 == 1, "Roadworks").otherwise("Incident").alias("eventType"),
        F.get(F.array(*[F.lit(s) for s in subtypes]), (eid % 7).cast("int")).alias("eventSubType"),
        F.concat(F.lit("Event "), eid).alias("description"),
        F.when(eid % 2 == 0, "").alias("closedRoadName"), F.when(eid % 3 == 0, "M1").alias("declaredRoadName"),
        local.alias("created"), F.when(eid % 4 == 0, local).when(eid % 4 == 1, "").alias("lastClosed"),
        F.when(eid % 2 == 0, F.concat(local, F.lit("+10:00"))).alias("lastUpdated"), local.alias("lastActive"),
        F.when(eid % 4 == 0, "2").when(eid % 4 == 1, "").when(eid % 4 == 2, "2.5").alias("numberLanesImpacted"),
        F.lit(" http://v ").alias("weblinkURL"),
        F.struct(F.concat(F.lit("Local "), F.col("user_id")).alias("localRoadName"),
                 F.lit("Cross").alias("startIntersectionRoadName"),
                 F.when(eid % 2 == 0, "").otherwise("Carlton").alias("startIntersectionLocality"),
                 F.lit("Fitzroy").alias("endIntersectionLocality"), F.lit("Yarra").alias("localGovernmentArea"),
                 F.lit("Metro").alias("closedRoadTransportRegion")).alias("reference"),
        F.struct(F.lit("Inbound").alias("direction")).alias("impact"))
    return _documents(e, I.FEED_C.box, p, None)


def incidents_a(spark, folder):
    return I.normalise_a(features(snapshots_a(spark, folder)))


def incidents_b(spark, folder):
    docs = snapshots_b(spark, folder)
    return I.normalise_b(features(docs).withColumn("position", F.col("event_id")))


def incidents_c(spark, folder):
    return I.normalise_c(features(snapshots_c(spark, folder)))


def _shown(df: DataFrame) -> DataFrame:
    """All 25 columns but the payload; coordinates rounded, groups joined."""
    flat = (df.drop("raw_payload").withColumn("attending_groups", F.array_join("attending_groups", ","))
            .withColumn("latitude", F.round("latitude", 9)).withColumn("longitude", F.round("longitude", 9)))
    return naive(flat)


def incident_normalise_a(spark, folder):
    return _shown(incidents_a(spark, folder))


def incident_normalise_b(spark, folder):
    return _shown(incidents_b(spark, folder))


def incident_normalise_c(spark, folder):
    return _shown(incidents_c(spark, folder))


def plain_incidents(df: DataFrame) -> DataFrame:
    """Events as already normalised incidents that are observed again and again."""
    eid, lon_lat = F.col("event_id"), _place(I.FEED_A.box)
    source = F.when(eid % 3 == 0, "tfnsw").when(eid % 3 == 1, "qldtraffic").otherwise("dtpvic")
    city = F.when(eid % 3 == 0, "sydney").when(eid % 3 == 1, "brisbane").otherwise("melbourne")
    return df.select(
        F.concat(source, F.lit(":"), eid % 300).alias("incident_id"), source.alias("source"),
        city.alias("city"), F.col("event_type"), (F.col("event_type") == "signup").alias("ended"),
        F.round(lon_lat[0], 9).alias("longitude"), F.round(lon_lat[1], 9).alias("latitude"),
        F.col("ts").alias("collected_at"), F.date_trunc("day", "ts").alias("last_updated"),
        F.date_trunc("hour", "ts").alias("start_time"), eid.cast("string").alias("raw_payload"))


def incident_latest(spark, folder):
    """Latest version per incident."""
    latest = I.latest_incidents(plain_incidents(events(spark, folder)))
    return naive(latest.select("incident_id", "source", "event_type", "last_updated", "collected_at",
                               "raw_payload"))


def incident_counts(spark, folder):
    return I.incident_counts(plain_incidents(events(spark, folder)))


def incident_lifecycle(spark, folder):
    return naive(I.lifecycle(plain_incidents(events(spark, folder))))


def incident_history(spark, folder):
    """Circle of 40 km around the Sydney centre, ten days."""
    day = lambda d: F.lit(d).cast("timestamp")
    found = I.history_query(plain_incidents(events(spark, folder)), -33.8688, 151.2093, 40.0,
                            day("2024-01-05"), day("2024-01-15"))
    return found.select("incident_id", "raw_payload", F.round("distance_km", 6).alias("distance_km"))


def backfill_windows(spark, folder):
    """Windows of at most 90 days from every order date to the end of its third following year."""
    o = TB.table(spark, folder, "orders")
    ranges = o.select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("start_time"),
                      (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(
                          (F.col("o_orderkey") % 400).cast("int"))).alias("end_time"))
    return naive(I.backfill_windows(ranges).select("o_orderkey", "window_start", "window_end"))


def poll_outcomes(spark, folder):
    """JSON log lines made from events, messages of the last day."""
    e = events(spark, folder)
    line = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ts"),
                              F.lit("INFO").alias("level"), F.col("event_type").alias("msg")))
    return I.poll_outcomes(e.select(line.alias("value")), F.lit("2024-01-20 00:00:00").cast("timestamp"))


def partition_keys(spark, folder):
    """Incidents per date, hour and compact stamp of the hour."""
    keys = V.partition_keys(F.date_trunc("hour", "collected_at"))
    return (plain_incidents(events(spark, folder))
            .groupBy(*[c.alias(n) for n, c in keys.items()]).agg(F.count(F.lit(1)).alias("n")))


def incident_durations(spark, folder):
    """Minutes from start to observation."""
    return plain_incidents(events(spark, folder)).select(
        "raw_payload", V.duration_minutes(F.col("start_time"), F.col("collected_at")).alias("minutes"))


def _replayed(spark, folder, transform, mode: str, name: str) -> str:
    """Events land in the order of their time, slice by slice; the query is started again for each."""
    out, state = SI.scratch(spark, f"{name}-out"), SI.scratch(spark, f"{name}-state")

    def step(landed: DataFrame) -> None:
        SI.run_to_end(transform(plain_incidents(landed)), mode, SI.append_batches(out), state)
    rows = TB.table(spark, folder, "events").select("event_id", "user_id", "event_type", "value",
                                                    F.col("ts").cast("timestamp").alias("ts"))
    replay(rows, F.unix_micros("ts"), step, name=name)
    return out


def incident_stream_dedup(spark, folder):
    """Stream: each (incident, version) once. A version is seen within one day, so older state goes."""
    out = _replayed(spark, folder, lambda s: SI.deduplicated(s, "1 day").select("incident_id", "last_updated"),
                    "append", "dedup")
    return naive(spark.read.parquet(out).drop("batch"))


def incident_hourly(spark, folder):
    """Stream: observations per hour and source; hours more than a day old leave the state."""
    out = _replayed(spark, folder, lambda s: SI.hourly_counts(s, "1 day", "source"), "update", "hourly")
    return naive(SI.newest_rows(spark, out, ["hour", "source"]))


def incident_stream_lifecycle(spark, folder):
    """Stream: first and last sighting per incident."""
    out = _replayed(spark, folder, SI.sightings, "update", "sightings")
    return naive(SI.newest_rows(spark, out, ["incident_id"]))


def incident_closed(spark, folder):
    """Stream: incidents that were not seen for an hour, by a timer per incident."""
    out = _replayed(spark, folder, lambda s: SI.closed_incidents(s, "1 hour", 60), "append", "closed")
    return naive(spark.read.parquet(out).drop("batch"))


QUERIES = {f.__name__: f for f in (
    incident_normalise_a, incident_normalise_b, incident_normalise_c, incident_latest,
    incident_counts, incident_lifecycle, incident_history, backfill_windows, poll_outcomes,
    partition_keys, incident_durations, incident_stream_dedup, incident_hourly,
    incident_stream_lifecycle, incident_closed)}
