"""Queries of the dataset catalogue over documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.functions import display as D
from hexloom.operators import catalogue as C
from hexloom.operators import statistics as ST
from hexloom.plans import testbed as TB
from hexloom.plans.geo_queries import rounded
from hexloom.plans.incident_queries import naive
from hexloom.sinks import writers as W
from hexloom.sources import catalogue as SC
from hexloom.streaming.incidents import scratch

NOW = "2025-03-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def datasets(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as dataset records; the text is the description."""
    d = F.col("doc_id")
    number = F.substr("source", F.lit(4)).cast("int")
    words = [F.lit(c) for c in (*C.CATEGORIES, "unlisted")]
    tags = F.transform(F.sequence(F.lit(1), (d % 6 + 1).cast("int")),
                       lambda i: F.concat(F.lit("Tag"), ((d + i) % 40).cast("string")))
    start = F.date_add(F.lit("2019-01-01").cast("date"), (d % 1000).cast("int"))
    end = F.when(d % 6 != 0, F.date_add(start, (d % 900).cast("int")))
    west, south = (d % 360).cast("double") - 180.0, (d % 150).cast("double") - 80.0
    return TB.table(spark, folder, "documents").select(
        F.concat(F.lit("doc-"), d).alias("id"), F.concat(F.lit("Doc "), d).alias("name"),
        F.get(F.array(*words), number % 8).alias("category"), F.col("lang").alias("region"),
        F.when(d % 2 == 0, "raw").otherwise("processed").alias("stage"),
        F.when(d % 7 != 0, F.concat(F.lit("pair-"), F.floor(d / 4.0))).alias("pair_id"),
        F.when(d % 10 == 0, "2020 only").alias("timespan"),
        F.when(d % 3 == 0, F.struct(start.alias("start"), end.alias("end"))).alias("temporal_range"),
        F.when(d % 3 == 0, "").when(d % 3 == 1, F.concat(F.lit("Team "), d % 11)).alias("maintainer"),
        F.col("n_chars").alias("size_bytes"), F.when(d % 5 != 0, d % 100).alias("file_count"),
        F.when(d % 6 == 0, "CSV").when(d % 6 == 1, "Parquet").when(d % 6 == 2, "JSON").alias("format"),
        (F.lit("2025-01-01").cast("timestamp") + F.make_dt_interval(
            F.lit(0), F.floor(d / 3.0).cast("int"))).alias("last_modified"),
        F.when(d % 4 == 0, F.array(west, south, west + 1.0, south + 2.0)).alias("bbox"),
        F.col("text").alias("description"), F.when(d % 6 != 5, tags).alias("tags"))


def files(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as objects of a store."""
    p = F.col("page_id")
    ext = (F.when(p % 5 == 0, ".parquet").when(p % 5 == 1, ".csv").when(p % 5 == 2, ".JSON")
           .when(p % 5 == 3, ".tar.gz").otherwise(""))
    path = F.regexp_extract("url", "^https?://[^/]+/([^?#]*)", 1)
    return TB.table(spark, folder, "pages").select(
        F.concat(F.when(p % 2 == 0, "raw/").otherwise("processed/"), path, ext).alias("key"),
        F.when(p % 50 == 0, 0).otherwise(F.length("html")).cast("bigint").alias("size"),
        (F.lit("2025-01-01").cast("timestamp") + F.make_dt_interval(
            F.lit(0), F.lit(0), p.cast("int"))).alias("last_modified"))


def _slim(df):
    return df.select("id")


def catalogue_kpis(spark, folder):
    return naive(C.kpis(datasets(spark, folder)))


def category_stats(spark, folder):
    return C.category_stats(datasets(spark, folder))


def region_stats(spark, folder):
    return C.region_stats(datasets(spark, folder))


def growth_curve(spark, folder):
    return naive(C.growth_curve(datasets(spark, folder)))


def pair_impact(spark, folder):
    return rounded(C.pair_impact(datasets(spark, folder)))


def format_histogram(spark, folder):
    return C.format_histogram(datasets(spark, folder))


def prefix_stats(spark, folder):
    return naive(C.prefix_stats(files(spark, folder)))


def prefix_datasets(spark, folder):
    """Prefix statistics joined with hand-kept entries that a document names."""
    entry = F.struct(F.concat(F.lit("Set "), "part").alias("name"), F.lit("weather").alias("category"),
                     F.when(F.col("part") == "en", "raw").alias("stage"))
    parts = (files(spark, folder).select(F.regexp_extract("key", "^raw/([^/]+)/", 1).alias("part"))
             .where("part <> ''").distinct())
    text = parts.select(F.to_json(F.struct(F.create_map(
        F.concat(F.lit("processed/"), "part", F.lit("/")), entry).alias("datasets"))).alias("value"))
    built = C.build_datasets(C.prefix_stats(files(spark, folder)), SC.entries_of(text))
    return naive(built.select("id", "name", "category", "region", "stage", "size_bytes", "file_count",
                              "format", "last_modified"))


def bbox_union(spark, folder):
    return C.bbox_union(datasets(spark, folder))


def category_lists(spark, folder):
    """Category members as lists of about a hundred ids."""
    lists = C.grouped_lists(datasets(spark, folder), "category", 100)
    return lists.select("category", "chunk", F.array_join("ids", ",").alias("ids"))


def raw_with_processed(spark, folder):
    return _slim(C.raw_with_processed(datasets(spark, folder)))


def pair_siblings(spark, folder):
    return C.pair_siblings(datasets(spark, folder))


def related_top3(spark, folder):
    return C.related_datasets(datasets(spark, folder))


def dataset_search(spark, folder):
    """Search over whole descriptions and all other fields, two categories, processed stage."""
    found = C.search(C.of_stage(datasets(spark, folder), "processed"), "Tag7", ["traffic", "weather", "energy"])
    return C.sort_datasets(found, "size").select("id", "size_bytes")


def text_search(spark, folder):
    """Datasets whose text or fields contain a word."""
    return _slim(C.search(datasets(spark, folder), "EN THE"))


def palette_search(spark, folder):
    return _slim(C.palette_search(datasets(spark, folder), "tag1 tag2"))


def timeline(spark, folder):
    return rounded(C.timeline(datasets(spark, folder), now()))


def undated_datasets(spark, folder):
    return C.without_range(datasets(spark, folder)).select("id", "name", "timespan")


def catalogue_document(spark, folder):
    """The catalogue written as a document and read back, every member of every record."""
    target = scratch(spark, "catalogue")
    W.write_catalogue(datasets(spark, folder), target, now())
    back = SC.read_catalogue(spark, target)
    corner = lambda i, n: F.get("bbox", F.lit(i)).alias(n)
    return naive(back).select(
        *[c for c in back.columns if c not in ("temporal_range", "bbox", "tags")],
        F.col("temporal_range.start").alias("start"), F.col("temporal_range.end").alias("end"),
        corner(0, "west"), corner(1, "south"), corner(2, "east"), corner(3, "north"),
        F.array_join("tags", ",").alias("tags"))


def visible_tags(spark, folder):
    v = C.visible_tags(datasets(spark, folder))
    return v.select("id", F.array_join("visible", ",").alias("visible"), "hidden")


def dataset_labels(spark, folder):
    """Sizes, counts, ages, spans and titles as shown to a reader."""
    d = datasets(spark, folder)
    size = F.col("size_bytes") * F.col("size_bytes") * 37
    ts = F.col("last_modified")
    return rounded(d.select(
        "id", D.format_bytes(size).alias("size_label"), D.format_number(size).alias("number_label"),
        D.time_ago(ts, now()).alias("ago"), D.days_since(ts, now()).alias("days"),
        D.recency(ts, now()).alias("recency"), D.age_percent(ts, now()).alias("age_pct"),
        D.timespan_label(F.col("timespan"), F.col("temporal_range.start"), F.col("temporal_range.end"))
        .alias("span"), D.title(F.col("pair_id")).alias("pair_label")))


def path_labels(spark, folder):
    """Id, title, extension, format and stage of every object key."""
    k = F.col("key")
    return files(spark, folder).select(
        "key", D.slug(k).alias("slug"), D.title_of_prefix(k).alias("title"),
        D.extension(k).alias("extension"), D.format_label(D.extension(k)).alias("format"),
        D.stage_of(k, F.when(k.endswith(".csv"), "raw")).alias("stage"))


def file_routing(spark, folder):
    """Zone key of every object as if its name were one of the pipeline's files."""
    names = [F.lit(n) for n in ("roads.parquet", "hex_features_res09.parquet", "combined_res08.parquet",
                                "satellite_hex_embeddings_res09.parquet", "extraction_metadata.json")]
    p = F.col("page_id")
    name = F.get(F.array(*names), (p % 5).cast("int"))
    return TB.table(spark, folder, "pages").select(
        "page_id", W.zone_key(name, F.concat(F.lit("city"), p % 3), F.lit("2026-02-18.0"), 9).alias("target"),
        W.content_type(name).alias("content_type"))


def layer_gaps(spark, folder):
    """Labelled documents asked for, raw datasets existing: what is missing."""
    wanted = TB.table(spark, folder, "labels").select(F.concat(F.lit("doc-"), "doc_id").alias("id"))
    return C.layer_gaps(wanted, C.of_stage(datasets(spark, folder), "raw"), "id")


def speed_summary(spark, folder):
    """Count, mean, extremes and quartiles of the parsed speed limit."""
    r = ST.summary(TB.roads(spark, folder), "speed_limit_kmh", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return rounded(r, 6)


QUERIES = {f.__name__: f for f in (
    catalogue_kpis, category_stats, region_stats, growth_curve, pair_impact, format_histogram,
    prefix_stats, prefix_datasets, bbox_union, category_lists, raw_with_processed, pair_siblings,
    related_top3, dataset_search, text_search, palette_search, timeline, undated_datasets, catalogue_document, visible_tags,
    dataset_labels, path_labels, file_routing, layer_gaps, speed_summary)}
