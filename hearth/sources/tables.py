"""Driver table loader (Parquet scans, S8).

A scan's parallelism comes from its files and row groups; sessions that read
small files set ``spark.sql.files.maxPartitionBytes`` to cut them finer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; callers ``select`` what they need so Catalyst prunes columns."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
