"""Exact order statistics by distributed selection.

Equal values are counted first; every figure follows from the counts. The values are cut into ranges at
points from a bounded summary. Totals of the ranges, a bounded number of rows, say which range holds a
wanted rank; running counts are made inside these ranges only, and the ranks are picked there. No task
sees all values, also when all of them differ.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexloom.session import cut_lineage


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n) of the values that are not null."""
    return (df.select(F.col(column).cast("double").alias("value")).where("value IS NOT NULL")
            .groupBy("value").agg(F.count(F.lit(1)).alias("n")))


def _ranges(counts: DataFrame, parts: int) -> DataFrame:
    """The counts with the number of their range."""
    shares = [i / parts for i in range(1, parts)]
    points = counts.agg(F.percentile_approx("value", shares, 10_000).alias("p")).first()["p"] or []
    number = F.size(F.filter(F.array(*map(F.lit, sorted(set(points)))), lambda p: p < F.col("value"))) if points else F.lit(0)
    return counts.withColumn("_range", number)


def ranked_values(counts: DataFrame, ranks: list[int], parts: int) -> dict[int, float]:
    """The value at each rank (from 0) of the counted values in ascending order."""
    ranged = _ranges(counts, parts)
    totals = sorted(map(tuple, ranged.groupBy("_range").agg(F.sum("n")).collect()))  # ``parts`` rows
    before, wanted = 0, {}
    for number, n in totals:
        for r in ranks:
            if before <= r < before + n:
                wanted.setdefault(number, []).append((r, r - before))
        before += n
    upto = F.sum("n").over(Window.partitionBy("_range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    near = ranged.where(F.col("_range").isin(list(wanted))).withColumn("_upto", upto)
    # one conditional maximum for each rank, so no more than one row comes back
    hit = lambda number, at: (F.col("_range") == number) & (F.col("_upto") - F.col("n") <= at) & (F.col("_upto") > at)
    asked = [(r, number, at) for number, some in wanted.items() for r, at in some]
    if not asked:
        return {}
    row = near.agg(*[F.max(F.when(hit(number, at), F.col("value"))) for _, number, at in asked]).first()
    return {r: row[i] for i, (r, _, _) in enumerate(asked)}


def summary(df: DataFrame, column: str, quantiles: Mapping[str, float], parts: int | None = None) -> DataFrame:
    """One row: count, mean, std (of a sample), min, the named exact quantiles, and max.

    Quantiles between two values are interpolated. Nulls do not count; without values count is 0 and
    the rest null.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = cut_lineage(value_counts(df, column))
    n, total, low, high = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.sum(F.col("value") * F.col("n")),
                                     F.min("value"), F.max("value")).first()
    places = {name: (n - 1) * share for name, share in quantiles.items()} if n else {}
    at = ranked_values(counts, sorted({f(p) for p in places.values() for f in (math.floor, math.ceil)}), parts)
    mean = total / n if n else None
    figure = lambda v: F.lit(v).cast("double")
    value = lambda p: at[math.floor(p)] + (at[math.ceil(p)] - at[math.floor(p)]) * (p - math.floor(p))
    apart = F.sum(F.col("n") * F.pow(F.col("value") - F.lit(mean), 2)) if n else F.lit(None).cast("double")
    return counts.agg(
        F.lit(n).cast("bigint").alias("count"), figure(mean).alias("mean"),
        (F.sqrt(apart / F.lit(n - 1)) if n > 1 else figure(None)).alias("std"), figure(low).alias("min"),
        *[figure(value(places[name]) if n else None).alias(name) for name in quantiles], figure(high).alias("max"))
