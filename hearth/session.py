"""Spark session helpers.

The library never builds its own cluster configuration: on a cluster the
session comes from the launcher. ``get_spark`` exists for tests, the bench
and local runs, and only fills in settings that are unset.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on for deterministic, ANSI-safe results.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "hearth") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder
        .master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        # remove checkpoint files of intermediate tables once they are garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in _REQUIRED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CKPT: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder: ``spark.checkpoint.dir``, or the one set on the context.

    Only a session in one JVM (``local[n]``, as in tests) gets a temporary folder of
    its own where neither is set; on a cluster executors could not see it, so that
    is an error there.
    """
    global _LOCAL_CKPT
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = os.path.dirname(sc.getCheckpointDir()) if sc.getCheckpointDir() else None   # Spark adds a folder of its own
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        if _LOCAL_CKPT is None:
            _LOCAL_CKPT = tempfile.mkdtemp(prefix="hearth-ckpt-", dir="/tmp")
        path = _LOCAL_CKPT
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the shared folder, which is set up first."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
