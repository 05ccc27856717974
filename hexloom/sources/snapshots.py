"""Incident snapshots: GeoJSON FeatureCollections, one file per feed and poll."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STAMP = r"(\d{8}T\d{6}Z)"


def features(documents: DataFrame, text: str = "value") -> DataFrame:
    """One row per feature with its compact JSON text; documents without features give none."""
    keep = [c for c in documents.columns if c != text]
    parsed = documents.select(*keep, F.from_json(text, "features array<string>").alias("_d"))
    return parsed.select(*keep, F.posexplode("_d.features").alias("position", "feature"))


def _stamped(raw: DataFrame) -> DataFrame:
    stamp = F.regexp_extract("_file", STAMP, 1)
    return raw.select("value", F.try_to_timestamp(stamp, F.lit("yyyyMMdd'T'HHmmss'Z'")).alias("collected_at"),
                      F.regexp_extract("_file", r"source=([^/]+)", 1).alias("source"))


def read_snapshots(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Archive replay: every snapshot under a folder with its poll time from the file name."""
    raw = (spark.read.text(path, wholetext=True, recursiveFileLookup=True)
           .select("value", F.col("_metadata.file_path").alias("_file")))
    found = _stamped(raw)
    return found.where(F.col("source") == source) if source else found


def stream_snapshots(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same files as a stream."""
    reader = spark.readStream.option("wholetext", True).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _stamped(reader.format("text").load(path)
                    .select("value", F.col("_metadata.file_path").alias("_file")))


GEOMETRY = ("struct<type:string,coordinates:string,"
            "geometries:array<struct<type:string,coordinates:string>>>")
_DIRECT = ("Point", "LineString", "MultiPoint", "Polygon", "MultiLineString", "MultiPolygon")
_NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"
_FIRST_PAIR = r"^[\[\s]*(" + _NUMBER + r"\s*,\s*" + _NUMBER + r")"


def _first_pair(kind: Column, coordinates: Column) -> Column:
    """The first two numbers of a coordinates text are its first vertex at any depth."""
    pair = F.split(F.regexp_extract(coordinates, _FIRST_PAIR, 1), ",").try_cast("array<double>")
    lon, lat = F.get(pair, F.lit(0)), F.get(pair, F.lit(1))
    return F.when(kind.isin(*_DIRECT) & lon.isNotNull() & lat.isNotNull(),
                  F.struct(lon.alias("lon"), lat.alias("lat")))


def first_coordinate(geometry: Column) -> Column:
    """Representative STRUCT<lon,lat>; a collection gives its first child that has one."""
    children = F.filter(F.transform(geometry["geometries"],
                                    lambda g: _first_pair(g["type"], g["coordinates"])),
                        lambda p: p.isNotNull())
    direct = _first_pair(geometry["type"], geometry["coordinates"])
    nested = F.when((geometry["type"] == "GeometryCollection") & geometry["coordinates"].isNull(),
                    F.get(children, F.lit(0)))
    return F.coalesce(direct, nested)


def read_incidents(spark: SparkSession, path: str, since: str | None = None,
                   until: str | None = None) -> DataFrame:
    """Normalised incidents; the date range prunes partitions."""
    df = spark.read.parquet(path)
    if since:
        df = df.where(F.col("dt") >= F.lit(since).cast("date"))
    if until:
        df = df.where(F.col("dt") <= F.lit(until).cast("date"))
    return df


def register_incidents(spark: SparkSession, table: str, path: str) -> None:
    """External table over the incident folder, partitions picked up from the paths."""
    from hexloom.schema import INCIDENT
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in INCIDENT.fields
                        if f.name not in ("city", "source"))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, dt STRING, city STRING, source STRING, poll STRING) "
              f"USING parquet PARTITIONED BY (dt, city, source, poll) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")
