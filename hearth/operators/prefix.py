"""Distributed running sum per group (skew-safe).

``running_sum(df, groups, order, weight)`` adds, to every row, the sum of
``weight`` over the rows of its group up to and including it in ``order``
— what ``sum(w) over (partition by groups order by order rows unbounded
preceding)`` gives — without ever placing a whole group in one task:

1. range-partition by (groups, order, row hash) and checkpoint with the
   partition id: each partition is a contiguous slice of the global order,
   and a group with very many rows spans many partitions;
2. per (group, slice) totals, and for each slice of a group that has several,
   the total of its earlier slices. Slices are contiguous, so only the groups
   at their ends have several: two rows per slice at most, which are broadcast;
3. a running sum inside each (group, slice) plus that offset.

The row hash only orders rows that are equal in every ``order`` column.
Also returned: ``_p`` (slice) and ``_rn`` (position within the slice);
``struct(_p, _rn)`` orders rows within a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable


def running_sum(df: DataFrame, groups: list[str], order: list, weight: str, out: str,
                partitions: int | None = None) -> DataFrame:
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    ranked = durable(df.withColumn("_tie", tie)
                     .repartitionByRange(n, *[F.col(g) for g in groups], *order, F.col("_tie"))
                     .withColumn("_p", F.spark_partition_id()))
    every = Window.partitionBy(*groups)
    before = every.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    slices = ranked.groupBy(*groups, "_p").agg(F.sum(weight).alias("_slice"))
    offsets = (slices.select(*[F.col(g).alias(f"_of_{g}") for g in groups], F.col("_p").alias("_of"),
                             F.coalesce(F.sum("_slice").over(before), F.lit(0)).alias("_off"),
                             F.count(F.lit(1)).over(every).alias("_slices"))
               .where("_slices > 1").drop("_slices"))
    same = F.col("_p") == F.col("_of")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    w = Window.partitionBy(*groups, "_p").orderBy(*order, F.asc("_tie"))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (ranked.join(F.broadcast(offsets), same, "left")
            .withColumn(out, F.coalesce("_off", F.lit(0)) + F.sum(weight).over(running))
            .withColumn("_rn", F.row_number().over(w))
            .drop("_tie", "_off", "_of", *[f"_of_{g}" for g in groups]))
