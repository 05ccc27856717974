"""Incident snapshots as a stream: normalise, de-duplicate, hourly counts, lifecycle."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from hexloom.operators.incidents import NORMALISERS
from hexloom.session import shared_folder
from hexloom.sinks.writers import POLL_FAILED, POLL_OK, write_incidents, write_poll_log, write_raw_snapshots
from hexloom.sources import snapshots

log = logging.getLogger(__name__)


def run_to_end(stream: DataFrame, mode: str, sink: Callable[[DataFrame, int], None],
               checkpoint: str) -> None:
    """Process everything available, then stop; a rerun continues from the checkpoint."""
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(sink).start())
    query.awaitTermination()


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def collect_feed(spark: SparkSession, source: str, inbox: str, raw: str, processed: str,
                 checkpoint: str, interval: str | None = "5 minutes", files_per_batch: int | None = None,
                 poll_log: str | None = None):
    """One query per feed: raw snapshots and normalised incidents of every micro-batch.

    A feed that fails stops only its own query. After downtime the checkpoint catches up. With
    ``poll_log`` every micro-batch leaves one JSON line: outcome, features, records and seconds.
    """
    normalise = NORMALISERS[source]

    def land(batch: DataFrame, batch_id: int) -> None:
        started, poll = time.monotonic(), f"{source}-{batch_id}"
        # names of the observations are as many as polls, so each belongs to one query run
        features, records = Observation(f"features-{uuid.uuid4().hex}"), Observation(f"records-{uuid.uuid4().hex}")
        try:
            found = batch.where(F.col("source") == source)
            write_raw_snapshots(found, raw, poll)
            parts = snapshots.features(found).withColumn("list_no", F.lit(0)).observe(features, F.count(F.lit(1)).alias("n"))
            write_incidents(normalise(parts).observe(records, F.count(F.lit(1)).alias("n")), processed, poll)
        except Exception as exc:
            if poll_log:
                write_poll_log(spark, poll_log, source, poll, {"msg": POLL_FAILED, "err": str(exc)[:500]})
            raise
        if poll_log:
            write_poll_log(spark, poll_log, source, poll, {
                "msg": POLL_OK, "raw_features": features.get["n"], "normalized_records": records.get["n"],
                "elapsed_sec": round(time.monotonic() - started, 2)})

    writer = (snapshots.stream_snapshots(spark, inbox, files_per_batch).writeStream
              .queryName(f"collect-{source}").option("checkpointLocation", checkpoint)
              .foreachBatch(land))
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def collect_all(spark: SparkSession, inbox: str, raw: str, processed: str, checkpoint: str,
                poll_log: str | None = None) -> dict[str, str]:
    """Catch up all feeds once; returns feed -> ok or failed."""
    outcome = {}
    for source in NORMALISERS:
        try:
            collect_feed(spark, source, f"{inbox}/source={source}", raw, processed,
                         f"{checkpoint}/{source}", interval=None, poll_log=poll_log).awaitTermination()
            outcome[source] = "ok"
        except Exception:  # the other feeds go on
            log.exception("feed %s failed", source)
            outcome[source] = "failed"
    return outcome


def deduplicated(incidents: DataFrame, delay: str) -> DataFrame:
    """First observation of every version of an incident.

    The delay must exceed the longest time an incident stays unchanged: later sightings do not
    refresh the state.
    """
    return (incidents.withWatermark("collected_at", delay)
            .dropDuplicatesWithinWatermark(["incident_id", "last_updated"]))


def hourly_counts(incidents: DataFrame, delay: str, *keys: str) -> DataFrame:
    return (incidents.withWatermark("collected_at", delay)
            .groupBy(F.window("collected_at", "1 hour").alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("hour"), *keys, "n"))


def sightings(incidents: DataFrame) -> DataFrame:
    """Running lifecycle per incident, for update mode."""
    return incidents.groupBy("incident_id").agg(
        F.min("collected_at").alias("first_seen"), F.max("collected_at").alias("last_seen"),
        F.count(F.lit(1)).alias("sightings"), F.bool_or("ended").alias("ended"))


def append_batches(folder: str) -> Callable[[DataFrame, int], None]:
    """Each micro-batch replaces its own folder, so a repeated batch changes nothing."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
    return sink


def newest_rows(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """Last emitted row per key of an update-mode output."""
    rows = spark.read.parquet(folder)
    window = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    return (rows.withColumn("_n", F.row_number().over(window)).where(F.col("_n") == 1)
            .drop("_n", "batch"))


def closed_incidents(incidents: DataFrame, delay: str, quiet_minutes: int = 60) -> DataFrame:
    """Every spell of an incident that ended with more than ``quiet_minutes`` without a sighting.

    Spells are session windows, so the rows do not depend on how the stream is cut into batches. The
    window goes on with every sighting, unlike a watermark de-duplication.
    """
    spells = (incidents.withWatermark("collected_at", delay)
              .groupBy("incident_id", F.session_window("collected_at", f"{quiet_minutes} minutes"))
              .agg(F.min("collected_at").alias("first_seen"), F.max("collected_at").alias("last_seen"),
                   F.count(F.lit(1)).alias("sightings")))
    return spells.drop("session_window")
