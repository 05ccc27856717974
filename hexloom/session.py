"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Static broadcast decisions rest on estimates, and an exploded relation is estimated at the
# size of its input. Only sizes measured at run time may lead to a broadcast.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Call sites in error messages cost milliseconds per Column call.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "hexloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """The same settings on a session that somebody else has built."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python once per application, as a zip."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="hexloom-ship-")) / "hexloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as bundle:
        for file in sorted(root.rglob("*.py")):
            bundle.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


#: Rows that a task of heavy per-row work gets at most, about.
TASK_ROWS = 250_000


def fill_cluster(df):
    """Spread a scan that has fewer splits than the cluster has cores, or too few for its rows.

    A table in one row group is read by one task, whatever follows, and a compressed split can hold millions
    of rows. The rows are counted from the file footers; tasks grow in number with them, not in length.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    wanted = max(cores, -(-df.count() // TASK_ROWS))
    return df.repartition(wanted) if splits < wanted else df


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local master may do without, in a temporary folder."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured:
        if not current:
            context.setCheckpointDir(configured)
        return configured
    if not current:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="hexloom-"))
        current = context.getCheckpointDir()
    return current


def cut_lineage(df):
    """Reliable checkpoint in the shared folder, so lost executors do not lose the rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
