"""Spark session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings, all of them changeable on a live session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # What a task reads, from an exchange or a file. Typed rows are some 30 times as wide in a
    # sort as what was exchanged for them: 64 MB of that are 3 GB of a task's memory. Small
    # tables are still dealt to all cores.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    # One hot CIG may hold a large share of a table. The joins below have at most
    # one row per key on the small side, so splitting the hot partition is enough;
    # force it also where the split costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Generated methods above 8,000 bytes are never compiled by the JVM. The wide typed
    # projections exceed that; without the limit they would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Only the year partitions present in the written frame are replaced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tenderlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
    )
    return tune(builder.getOrCreate())


# Folders of sessions on one machine, removed when the process ends.
_OWN: dict[str, tempfile.TemporaryDirectory] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the folder all executors share.

    That folder is the one the session names in spark.checkpoint.dir. Only a session
    on one machine may go without it; it gets one folder of its own, gone with it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = tempfile.TemporaryDirectory(prefix="tenderlake-")
        shared = _OWN[app].name
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
