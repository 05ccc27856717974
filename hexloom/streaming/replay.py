"""A finished table as a stream: landed slice by slice, each processed before the next one arrives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexloom.streaming.incidents import scratch

#: Slices that a replay lands if nothing else is said.
SLICES = 7


def slice_bounds(rows: DataFrame, at: Column, slices: int) -> list[tuple[int, int]]:
    """Spans [low, high) of like width over a whole-number column; none for a table without values."""
    low, high = rows.agg(F.min(at), F.max(at)).first()
    if low is None:
        return []
    width = (high - low) // slices + 1
    return [(low + i * width, low + (i + 1) * width) for i in range(slices)]


def replay(rows: DataFrame, at: Column, step: Callable[[DataFrame], None], slices: int = SLICES,
           name: str = "replay") -> int:
    """Land rows in the order of ``at`` and run ``step`` over the growing folder after each slice.

    ``step`` gets the stream of the folder and processes what is new, so every slice is a micro-batch of
    its own in a query that was stopped and started again. A slice may be many files: they meet in one
    batch, and all its rows stand before those of the next slice. Rows without a value of ``at`` come with
    the first slice. Returns the number of slices landed.
    """
    spark, inbox = rows.sparkSession, scratch(rows.sparkSession, f"{name}-in")
    spans = slice_bounds(rows, at, slices) or [(0, 1)]
    for i, (low, high) in enumerate(spans):
        inside = (at >= low) & (at < high)
        rows.where(inside if i else inside | at.isNull()).write.parquet(f"{inbox}/slice-{i:05d}")
        step(spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(inbox))
    return len(spans)
