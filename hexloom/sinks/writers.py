"""Sinks: layers, incidents, raw snapshots, manifests, zone routing, catalogue documents."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.functions import values as V
from hexloom.sources.catalogue import MEMBERS


def write_layer(df: DataFrame, folder: str, layer: str) -> None:
    """One layer as Parquet; an empty layer still writes its schema."""
    df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{layer}.parquet")


def one_line(document: Column) -> Column:
    """JSON on one line: a line break inside it can only be layout, strings escape theirs."""
    return F.regexp_replace(document, r"[\r\n]+", " ")


def _by_poll(df: DataFrame, poll: str | None, *keys: str):
    """Writer by keys and poll. A repeated poll replaces its own partitions and nothing else."""
    stamp = V.partition_keys(F.col("collected_at"))["stamp"]
    name = F.concat(stamp, F.lit(f"-{poll}")) if poll else stamp
    kept = df.withColumn("poll", name)
    if "raw_payload" not in kept.columns:
        kept = kept.drop("collected_at")  # a text file holds the value alone
    return (kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys, "poll"))


def write_incidents(incidents: DataFrame, folder: str, poll: str | None = None) -> None:
    """Parquet under dt / city / source / poll. Nothing is written for no records.

    City and source live in the path only, as a copy in the file would be shadowed by it.
    """
    keyed = incidents.withColumn("dt", V.partition_keys(F.col("collected_at"))["dt"])
    _by_poll(keyed, poll, "dt", "city", "source").option("compression", "zstd").parquet(folder)


def write_raw_snapshots(documents: DataFrame, folder: str, poll: str | None = None) -> None:
    """Unfiltered payloads as gzipped text under source / dt / hour / poll."""
    keys = V.partition_keys(F.col("collected_at"))
    keyed = documents.select(one_line(F.col("value")).alias("value"), "source", "collected_at", keys["dt"].alias("dt"),
                             keys["hour"].alias("hour"))
    writer = _by_poll(keyed, poll, "source", "dt", "hour")
    writer.option("compression", "gzip").text(folder)


def write_backfill(documents: DataFrame, folder: str, source: str = "tfnsw-historical") -> None:
    """History answers under the start date of their window.

    ``documents`` has value, window_start, window_end; the text row keeps one answer per line. A window
    that is fetched again replaces its former answers and no others.
    """
    keyed = documents.select(one_line(F.col("value")).alias("value"), F.lit(source).alias("source"),
                             V.partition_keys(F.col("window_start"))["dt"].alias("dt"))
    (keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "dt")
     .option("compression", "gzip").text(folder))


def manifest(counts: DataFrame, release: str, schema_version: str, extracted_at: Column) -> DataFrame:
    """One-row manifest from (layer, row_count)."""
    entries = F.sort_array(F.collect_list(F.struct("layer", "row_count")))
    return counts.agg(entries.alias("e")).select(
        F.lit("map-lake").alias("source"), F.lit(release).alias("release"),
        F.lit(schema_version).alias("schema_version"),
        F.col("e.layer").alias("layers_extracted"), F.map_from_entries("e").alias("row_counts"),
        F.date_format(extracted_at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("extraction_timestamp"))


def write_manifest(doc: DataFrame, folder: str) -> None:
    doc.coalesce(1).write.mode("overwrite").json(f"{folder.rstrip('/')}/extraction_metadata")


# Names of the files that go to the raw zone.
RAW_FILES = (
    "roads.parquet pois.parquet buildings.parquet landuse.parquet addresses.parquet "
    "infrastructure.parquet land_cover.parquet connectors.parquet building_parts.parquet "
    "divisions.parquet division_areas.parquet division_boundaries.parquet bathymetry.parquet "
    "extraction_metadata.json").split()


def zone_key(name: Column, city: Column, release: Column, res: int, satellite: bool = True,
             collection: str = "map-lake") -> Column:
    """Target key of a pipeline file by zone; null for files that stay local."""
    tag = f"res{res:02d}"
    processed = [f"hex_features_raw_{tag}.parquet", f"hex_features_{tag}.parquet",
                 f"combined_{tag}.parquet"]
    place = lambda zone: F.concat_ws("/", F.lit(zone), F.lit(collection), city, release, name)
    key = F.when(name.isin(*RAW_FILES), place("raw")).when(name.isin(*processed), place("processed"))
    if satellite:
        key = key.when(name == f"satellite_hex_embeddings_{tag}.parquet",
                       F.concat_ws("/", F.lit("processed"), F.lit(f"{collection}_satellite"), city, name))
    return key


def content_type(name: Column) -> Column:
    return F.when(name.endswith(".json"), F.lit("application/json")).otherwise(
        F.lit("application/octet-stream"))


def write_catalogue(datasets: DataFrame, folder: str, generated_at: Column) -> None:
    """Catalogue document as sorted JSON lines, one record each, plus a one-row header.

    The members have the names of a ``{"datasets": [...]}`` document; ``read_catalogue`` reads them.
    Written by range, so no task holds the whole document; part files follow the sort order.
    """
    base = folder.rstrip("/")
    records = datasets.orderBy(F.desc("size_bytes"), "id").withColumnsRenamed(MEMBERS)
    (records.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
     .json(f"{base}/datasets"))
    header = datasets.agg(F.count(F.lit(1)).alias("dataset_count"),
                          F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_size_bytes"))
    (header.withColumn("generated_at", generated_at).coalesce(1)
     .write.mode("overwrite").json(f"{base}/header"))


# Messages of the poll log.
POLL_OK, POLL_FAILED = "poll_source_ok", "poll_source_failed"


def write_poll_log(spark: SparkSession, folder: str, source: str, poll: str, entry: dict) -> None:
    """One JSON line for one feed and poll; a repeated poll replaces its own line."""
    level = "ERROR" if entry["msg"] == POLL_FAILED else "INFO"
    line = json.dumps({"ts": dt.datetime.now(dt.timezone.utc).isoformat(), "level": level, "source": source, **entry},
                      ensure_ascii=False)
    (spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite")
     .text(f"{folder.rstrip('/')}/source={source}/poll={poll}"))
