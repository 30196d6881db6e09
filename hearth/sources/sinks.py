"""Sinks (K1-K5): Parquet (optionally partitioned), small CSV exports, views/tables, verified writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: str | list[str] | None = None) -> None:
    """Overwrite Parquet, optionally hive-partitioned (K1, K2).

    Partitioned writes go through a ``rebalance`` on the partition columns:
    rows of one value meet in few tasks (few files per value instead of one
    per task and value), while AQE splits a skewed value — one area holding
    a third of the rows — over several tasks and coalesces small ones.
    """
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        df.hint("rebalance", *cols).write.mode("overwrite").partitionBy(*cols).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_small_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header (K3). Only for report-sized results
    (one row per area or per type): ``coalesce(1)`` funnels all rows through
    one task."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_tab_files(df: DataFrame, path: str, file_by: str | None = None) -> None:
    """Tab-separated text with a header, as the raw lettings files are shipped: a file for each value of ``file_by``, if given."""
    if file_by:
        df.repartition(file_by).write.mode("overwrite").partitionBy(file_by).option("header", True).option("sep", "\t").csv(path)
    else:
        df.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def materialise(df: DataFrame, name: str, as_table: bool = False) -> DataFrame:
    """Register as a temp view, or save as a managed table (K4)."""
    if as_table:
        df.write.mode("overwrite").saveAsTable(name)
        return df.sparkSession.table(name)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_verified(df: DataFrame, path: str, partition_by: str | list[str] | None = None) -> int:
    """Write, counting rows during the write itself (``observe``), then check the
    re-read count — served from Parquet footers — equals it (K5)."""
    obs = Observation("write")
    write_parquet(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, partition_by)
    written = obs.get["rows"]
    reread = df.sparkSession.read.parquet(path).count()
    if reread != written:
        raise RuntimeError(f"write verification failed for {path}: wrote {written}, read {reread}")
    return written
