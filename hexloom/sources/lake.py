"""Readers for the partitioned Parquet lake and for saved layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.schema import LAKE_TYPES


def read_lake(spark: SparkSession, base: str, release: str, kind: str) -> DataFrame:
    """One type of one release. The release is a path part, theme and type are partitions."""
    theme, columns = LAKE_TYPES[kind]
    return (spark.read.schema(f"{columns}, theme string, type string")
            .parquet(f"{base.rstrip('/')}/release/{release}")
            .where((F.col("theme") == theme) & (F.col("type") == kind))
            .drop("theme", "type"))


def read_layer(spark: SparkSession, folder: str, layer: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{layer}.parquet")


def layer_exists(spark: SparkSession, folder: str, layer: str) -> bool:
    """A single file, or a folder whose write came to its end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{layer}.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.isFile(path) or files.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))


def row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer (layer, row_count), zero included, in one job.

    Parquet answers the counts from file footers.
    """
    counted = None
    for name, df in layers.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        counted = one if counted is None else counted.unionAll(one)
    return counted
