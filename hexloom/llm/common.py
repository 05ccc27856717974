"""What the corpus operators share: reading, batch mapping, scratch tables, the fold of a row."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.session import shared_folder

#: Rows of an Arrow batch; with texts of 100 kB a batch stays within tens of MB.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> None:
    """Batch sizes for columns of whole texts; only small tables, by measured size, are broadcast."""
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1MB")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def residue(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
                schema: str) -> DataFrame:
    """Map Arrow batches; ``make`` runs once per task and returns the function of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            yield fn(batch)
    return df.mapInArrow(run, schema)


def set_aside(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows with all columns but the needed ones under names that clash with nothing, and the way back."""
    names = {c: c if c in needed else f"aside_{i}" for i, c in enumerate(df.columns)}
    hidden = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return hidden, lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()])


@contextmanager
def without_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Small relations are merged as well while many short joins run: each broadcast costs the driver a thread and buffers."""
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def spread(df: DataFrame) -> DataFrame:
    """As many partitions as shuffles have, for work that costs far more than the exchange."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


_scratch: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/scratch-{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage ends, columns stay prunable.

    The files survive lost executors; a later reader reads only the columns it needs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch() -> None:
    """Delete every scratch table of this driver."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may be gone already
            return


atexit.register(drop_scratch)
