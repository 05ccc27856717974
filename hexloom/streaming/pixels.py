"""Pixel means that survive interruption: partial sums per micro-batch, one final aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.streaming.incidents import append_batches, run_to_end


def partial_sums(pixels: DataFrame, bands: int, band: str = "band") -> DataFrame:
    """Sum of every band and pixel count per cell."""
    valid = pixels.where(f"get({band}, 0) IS NOT NULL AND NOT isnan(get({band}, 0))")
    return valid.groupBy("cell_id").agg(F.expr("count(1)").alias("pixel_count"), *[
        F.expr(f"sum(CAST(get({band}, {i}) AS DOUBLE))").alias(f"s{i:02d}") for i in range(bands)])


def merge_sums(partials: DataFrame, bands: int) -> DataFrame:
    """Means from any number of partial sums."""
    n = "sum(pixel_count)"
    return partials.groupBy("cell_id").agg(F.expr(n).alias("pixel_count"), *[
        F.expr(f"sum(s{i:02d}) / {n}").alias(f"A{i:02d}") for i in range(bands)])


def _home(folder: str, grid: str) -> str:
    return f"{folder.rstrip('/')}/grid={grid}"


def add_sums(pixels: DataFrame, bands: int, folder: str, grid: str = "all") -> None:
    """Save the partial sums of what is new in a stream of tile files."""
    home = _home(folder, grid)
    save = append_batches(f"{home}/sums")
    run_to_end(pixels, "append", lambda batch, i: save(partial_sums(batch, bands), i), f"{home}/state")


def saved_means(spark: SparkSession, bands: int, folder: str, grid: str = "all") -> DataFrame:
    """Means of everything saved so far."""
    return merge_sums(spark.read.parquet(f"{_home(folder, grid)}/sums"), bands)


def resumable_means(spark: SparkSession, pixels: DataFrame, bands: int, folder: str,
                    grid: str = "all") -> DataFrame:
    """Means over a stream of tile files; a second call goes on where the first one stopped.

    Progress is kept per ``grid``, a text that names the tiling: another tiling starts afresh.
    Tiles without valid pixels are done once read.
    """
    add_sums(pixels, bands, folder, grid)
    return saved_means(spark, bands, folder, grid)
