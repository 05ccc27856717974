"""Catalogue sources: object listings, hand-kept entries and dataset documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.schema import DATASET

ENTRY = ("struct<name:string,category:string,region:string,stage:string,pairId:string,"
         "description:string,bbox:array<double>,tags:array<string>,maintainer:string,license:string,"
         "sourceUrl:string,timespan:string,temporalRange:struct<start:date,end:date>>")

# JSON member of every dataset column.
MEMBERS = {"pair_id": "pairId", "source_url": "sourceUrl", "size_bytes": "sizeBytes",
           "file_count": "fileCount", "last_modified": "lastModified",
           "temporal_range": "temporalRange"}


def read_listing(spark: SparkSession, root: str) -> DataFrame:
    """(key, size, last_modified) of every object under a folder; contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    key = F.substr("path", F.lit(len(full.rstrip("/")) + 2))
    return files.select(key.alias("key"), F.col("length").alias("size"),
                        F.col("modificationTime").alias("last_modified"))


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Hand-kept entries by prefix from ``{"datasets": {prefix: entry}}``."""
    text = spark.read.text(path, wholetext=True)
    return entries_of(text)


def entries_of(text: DataFrame, column: str = "value") -> DataFrame:
    parsed = F.from_json(column, f"datasets map<string,{ENTRY}>")
    return (text.select(F.explode(parsed["datasets"]).alias("prefix", "e"))
            .select("prefix", *[F.col(f"e.{MEMBERS.get(n, n)}").alias(n) for n in (
                "name", "category", "region", "stage", "pair_id", "description", "bbox", "tags",
                "maintainer", "license", "source_url", "timespan", "temporal_range")]))


def read_datasets(spark: SparkSession, path: str) -> DataFrame:
    """Dataset records of ``{"datasets": [record, ...]}`` documents."""
    return datasets_of(spark.read.text(path, wholetext=True))


def datasets_of(text: DataFrame, column: str = "value") -> DataFrame:
    record = ",".join(f"{MEMBERS.get(f.name, f.name)}:{f.dataType.simpleString()}" for f in DATASET.fields)
    parsed = F.from_json(column, f"datasets array<struct<{record}>>")
    return (text.select(F.explode(parsed["datasets"]).alias("d"))
            .select(*[F.col(f"d.{MEMBERS.get(f.name, f.name)}").alias(f.name) for f in DATASET.fields]))


def read_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Dataset records of a written catalogue; members that no record has are null."""
    shape = ",".join(f"{MEMBERS.get(f.name, f.name)} {f.dataType.simpleString()}" for f in DATASET.fields)
    lines = spark.read.schema(shape).json(f"{folder.rstrip('/')}/datasets")
    return lines.withColumnsRenamed({member: name for name, member in MEMBERS.items()})
