"""Spark session settings shared by tests, the bench and the driver entry.

On a cluster the session comes from the platform; ``configure`` only fills in
settings that are still unset, so cluster values always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings this library relies on.  ANSI mode is the 4.x default and is kept
# on: integer overflow and bad casts raise instead of silently wrapping.
DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark only broadcasts a join side whose planned (or, under AQE, measured)
    # size is below this bound; larger sides fall back to a shuffle join.
    # Spark uses this one under AQE too, unless the session sets AQE's own.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS where the session does not set them already."""
    conf = spark.conf
    for key, value in DEFAULTS.items():
        if conf.get(key, None) in (None, ""):
            conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlint") -> SparkSession:
    """A local session for tests and the bench (UI off, checkpoint dir set)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGERLINT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a bare local session (tests) gets a fresh temporary folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="ledgerlint-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
