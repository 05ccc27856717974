"""Incident feeds to one schema, latest versions, counts, history windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.functions import geometry as G
from hexloom.functions import values as V
from hexloom.functions.plan import once
from hexloom.schema import INCIDENT
from hexloom.sources.snapshots import GEOMETRY, first_coordinate


@dataclass(frozen=True)
class Feed:
    source: str
    city: str
    box: tuple[float, float, float, float]
    properties: str
    time_zone: str = "UTC"


# City boxes (min lon, min lat, max lon, max lat), kept categories and their types.
CITY_BOXES = {
    "sydney": (150.5, -34.2, 151.5, -33.5),
    "melbourne": (144.5, -38.1, 145.5, -37.5),
    "brisbane": (152.7, -27.8, 153.3, -27.2),
}
CATEGORY_TYPES = {
    "CRASH": "crash", "BREAKDOWN": "breakdown", "HAZARD": "hazard", "ADVERSE WEATHER": "hazard",
    "FLOOD": "flood", "FIRE": "fire", "TRAFFIC LIGHTS BLACKED OUT": "hazard",
    "TRAFFIC LIGHTS FLASHING YELLOW": "hazard", "EMERGENCY ROADWORK": "roadwork",
}
KEPT_EVENT_TYPES = ("Crash", "Hazard", "Flooding", "Congestion")
EVENT_TYPES = {
    "Crash": "crash", "Hazard": "hazard", "Flooding": "flood", "Congestion": "congestion",
    "Roadworks": "roadwork", "Special event": "event",
}
PRIORITY_SEVERITY = {"Red Alert": "major", "High": "high", "Medium": "medium", "Low": "low"}

FEED_A = Feed("tfnsw", "sydney", CITY_BOXES["sydney"], """struct<incidentKind:string,
    mainCategory:string,subCategoryA:string,displayName:string,headline:string,isMajor:boolean,
    ended:boolean,hideEndDate:boolean,created:bigint,start:bigint,end:bigint,lastUpdated:bigint,
    attendingGroups:array<string>,webLinks:array<struct<linkText:string,linkURL:string>>,
    weblinkUrl:string,roads:array<struct<mainStreet:string,crossStreet:string,suburb:string,
    region:string,impactedLanes:array<string>>>>""")
FEED_B = Feed("qldtraffic", "brisbane", CITY_BOXES["brisbane"], """struct<id:string,event_type:string,
    event_subtype:string,event_priority:string,description:string,advice:string,information:string,
    published:string,last_updated:string,web_link:string,url:string,
    impact:struct<direction:string>,duration:struct<start:string,end:string>,
    road_summary:struct<road_name:string,locality:string,local_government_area:string,
    district:string>>""")
FEED_C = Feed("dtpvic", "melbourne", CITY_BOXES["melbourne"], """struct<id:string,eventId:string,
    impactId:string,eventType:string,event_type:string,eventSubType:string,event_subtype:string,
    description:string,closedRoadName:string,declaredRoadName:string,created:string,
    lastClosed:string,lastUpdated:string,lastActive:string,numberLanesImpacted:string,
    weblinkURL:string,reference:struct<localRoadName:string,startIntersectionRoadName:string,
    startIntersectionLocality:string,endIntersectionLocality:string,localGovernmentArea:string,
    closedRoadTransportRegion:string>,impact:struct<direction:string>>""", "Australia/Melbourne")


def parse_features(features: DataFrame, feed: Feed) -> DataFrame:
    """Adds id, properties and the representative coordinate to feature texts, parsed once."""
    shape = f"id string, geometry {GEOMETRY}, properties {feed.properties}"
    names = [c for c in features.columns if c != "source"]
    parsed = features.select(*names, once(F.from_json("feature", shape)).alias("_f"))
    return parsed.select(*names, F.col("_f.id").alias("id"), F.col("_f.properties").alias("p"),
                         once(first_coordinate(F.col("_f.geometry"))).alias("at"))


def _conform(df: DataFrame, feed: Feed, columns: dict[str, Column]) -> DataFrame:
    """The 25 incident columns in order; whatever a feed lacks is null."""
    full = {"source": F.lit(feed.source), "city": F.lit(feed.city), "latitude": F.col("at.lat"),
            "longitude": F.col("at.lon"), "collected_at": F.col("collected_at"),
            "raw_payload": F.col("feature"), **columns}
    return df.select(*[full.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in INCIDENT.fields])


def _inside(feed: Feed) -> Column:
    return F.col("at").isNotNull() & G.in_box(F.col("at.lon"), F.col("at.lat"), feed.box)


def normalise_a(features: DataFrame) -> DataFrame:
    """Unplanned incidents of the kept categories inside the city box."""
    p = F.col("p")
    category = F.upper(F.coalesce(p["mainCategory"], F.lit("")))
    planned = F.coalesce(p["incidentKind"] == "Planned", F.lit(False))
    kept = (parse_features(features, FEED_A)
            .where(~planned & category.isin(*CATEGORY_TYPES) & _inside(FEED_A)))
    road = F.get(p["roads"], F.lit(0))
    yes = lambda name: F.coalesce(p[name], F.lit(False))
    return _conform(kept, FEED_A, {
        "incident_id": F.concat(F.lit(FEED_A.source + ":"), F.coalesce("id", F.lit("None"))),
        "event_type": V.lookup(category, CATEGORY_TYPES, "other"),
        "event_subtype": F.coalesce(V.safe_text(p["subCategoryA"]), V.safe_text(p["incidentKind"])),
        "severity": F.when(yes("isMajor"), "major").otherwise("normal"),
        "road_name": V.safe_text(road["mainStreet"]),
        "cross_street": V.safe_text(road["crossStreet"]),
        "suburb": V.safe_text(road["suburb"]), "region": V.safe_text(road["region"]),
        "description": V.safe_text(p["displayName"]), "headline": V.safe_text(p["headline"]),
        "start_time": F.coalesce(V.epoch_ms(p["start"]), V.epoch_ms(p["created"])),
        "end_time": F.when(~yes("hideEndDate"), V.epoch_ms(p["end"])),
        "ended": yes("ended"), "last_updated": V.epoch_ms(p["lastUpdated"]),
        "lanes_affected": F.nullif(F.when(road["impactedLanes"].isNotNull(), F.size(road["impactedLanes"])),
                                   F.lit(0)),
        "attending_groups": p["attendingGroups"],
        "source_url": F.coalesce(V.safe_text(F.get(p["webLinks"], F.lit(0))["linkURL"]),
                                 V.safe_text(p["weblinkUrl"])),
    })


def last_version(parsed: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by the given order columns.

    Spark keeps only the first row of each key per task before the exchange, so a key that holds
    most rows does not load one task.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return parsed.withColumn("_n", F.row_number().over(window)).where(F.col("_n") == 1).drop("_n")


def normalise_b(features: DataFrame) -> DataFrame:
    """Two lists per poll (``list_no``); the later list wins per id, then type and box filters.

    Only the id is read ahead of the choice, so texts alone are sorted; what is chosen is parsed in full.
    """
    p = F.col("p")
    native = F.from_json("feature", "properties struct<id:string>")["properties"]["id"]
    named = features.select("*", once(native).alias("_id")).where(F.col("_id").isNotNull())
    single = last_version(named, ["collected_at", "_id"], ["list_no", "position"]).drop("_id")
    kept = parse_features(single, FEED_B).where(p["event_type"].isin(*KEPT_EVENT_TYPES) & _inside(FEED_B))
    road, span = p["road_summary"], p["duration"]
    time = V.iso_time
    return _conform(kept, FEED_B, {
        "incident_id": F.concat(F.lit(FEED_B.source + ":"), p["id"]),
        "event_type": V.lookup(p["event_type"], EVENT_TYPES, "other"),
        "event_subtype": V.safe_text(p["event_subtype"]),
        "severity": V.lookup(p["event_priority"], PRIORITY_SEVERITY),
        "road_name": V.safe_text(road["road_name"]), "suburb": V.safe_text(road["locality"]),
        "lga": V.safe_text(road["local_government_area"]), "region": V.safe_text(road["district"]),
        "description": V.safe_text(p["description"]),
        "headline": F.coalesce(V.safe_text(p["advice"]), V.safe_text(p["information"])),
        "start_time": F.coalesce(time(span["start"]), time(p["published"])),
        "end_time": time(span["end"]), "ended": F.lit(False),
        "last_updated": F.coalesce(time(p["last_updated"]), time(p["published"])),
        "direction": V.safe_text(p["impact"]["direction"]),
        "source_url": V.safe_text(V.first_truthy(p["web_link"], p["url"])),
    })


def normalise_c(features: DataFrame) -> DataFrame:
    """Box filter only; the event type comes from the texts, naive times are local."""
    p = F.col("p")
    kept = parse_features(features, FEED_C).where(_inside(FEED_C))
    ref = p["reference"]
    kind = V.first_truthy(p["eventType"], p["event_type"])
    subtype = V.first_truthy(p["eventSubType"], p["event_subtype"])
    time = lambda c: V.iso_time(c, FEED_C.time_zone)
    native = F.coalesce(V.first_truthy(p["id"], p["eventId"], p["impactId"]), F.lit("None"))
    return _conform(kept, FEED_C, {
        "incident_id": F.concat(F.lit(FEED_C.source + ":"), native),
        "event_type": V.classify(subtype, kind), "event_subtype": V.safe_text(subtype),
        "road_name": V.safe_text(V.first_truthy(p["closedRoadName"], p["declaredRoadName"],
                                                ref["localRoadName"])),
        "cross_street": V.safe_text(ref["startIntersectionRoadName"]),
        "suburb": V.safe_text(V.first_truthy(ref["startIntersectionLocality"],
                                             ref["endIntersectionLocality"])),
        "lga": V.safe_text(ref["localGovernmentArea"]),
        "region": V.safe_text(ref["closedRoadTransportRegion"]),
        "description": V.safe_text(p["description"]),
        "start_time": time(p["created"]), "end_time": time(p["lastClosed"]),
        "ended": F.coalesce(p["lastClosed"] != "", F.lit(False)),
        "last_updated": time(V.first_truthy(p["lastUpdated"], p["lastActive"])),
        "lanes_affected": V.safe_int(p["numberLanesImpacted"]),
        "direction": V.safe_text(p["impact"]["direction"]),
        "source_url": V.safe_text(p["weblinkURL"]),
    })


NORMALISERS = {FEED_A.source: normalise_a, FEED_B.source: normalise_b, FEED_C.source: normalise_c}


def latest_incidents(incidents: DataFrame) -> DataFrame:
    """Latest version of every incident by update time, then by poll time."""
    return last_version(incidents, ["incident_id", "source"],
                        ["last_updated", "collected_at", "raw_payload"])


def incident_counts(incidents: DataFrame) -> DataFrame:
    return (incidents.groupBy("city", "event_type").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("city", F.desc("n"), "event_type"))


def lifecycle(incidents: DataFrame) -> DataFrame:
    """First and last sighting, number of sightings, and whether it was ever reported ended."""
    return incidents.groupBy("incident_id").agg(
        F.min("collected_at").alias("first_seen"), F.max("collected_at").alias("last_seen"),
        F.count(F.lit(1)).alias("sightings"), F.bool_or("ended").alias("ended"))


def backfill_windows(ranges: DataFrame, max_days: int = 90) -> DataFrame:
    """Contiguous [window_start, window_end) of at most ``max_days`` over start_time..end_time."""
    step = F.expr(f"INTERVAL {max_days} DAYS")
    starts = F.when(F.col("start_time") < F.col("end_time"),
                    F.sequence("start_time", "end_time", step))
    w = ranges.withColumn("window_start", F.explode(starts)).where(
        F.col("window_start") < F.col("end_time"))
    return w.withColumn("window_end", F.least(F.col("window_start") + step, F.col("end_time")))


def history_query(incidents: DataFrame, lat: float, lon: float, radius_km: float,
                  since: Column, until: Column) -> DataFrame:
    """Incidents inside a circle that started within a period.

    A latitude band, which a Parquet reader can use, goes first.
    """
    reach = radius_km / 110.0
    distance = G.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(lat), F.lit(lon))
    return (incidents.where(F.col("latitude").between(lat - reach, lat + reach))
            .where(F.col("start_time").between(since, until))
            .withColumn("distance_km", distance).where(F.col("distance_km") <= radius_km))


def poll_outcomes(log: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Messages of a JSON-lines poll log in the last hours: (msg, n)."""
    parsed = log.select(F.from_json("value", "ts timestamp, level string, msg string").alias("e"))
    recent = parsed.where((F.col("e.ts") > now - F.expr(f"INTERVAL {hours} HOURS")) & (F.col("e.ts") <= now))
    return recent.groupBy(F.col("e.msg").alias("msg")).agg(F.count(F.lit(1)).alias("n"))
