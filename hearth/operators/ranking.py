"""Ranking operators.

Ranks over a whole table use an unpartitioned window, which Spark runs in a
single task. They are only applied after aggregation to one row per area or
per type, whose count is bounded by the domain (tens to hundreds of rows),
never to raw rows. Per-group top-N is partitioned by the group key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def composite_rank(df: DataFrame, measures: dict[str, str], score: str = "priority_score",
                   rank: str = "priority_rank", tie_break: str | None = None) -> DataFrame:
    """Dense-rank each measure descending, average the ranks (1 dp), dense-rank the score.

    ``measures`` maps output rank column -> measure column. Rank 1 = highest
    measure. A lower score = higher priority.
    """
    out = df
    for rank_col, measure in measures.items():
        out = out.withColumn(rank_col, F.dense_rank().over(Window.orderBy(F.col(measure).desc_nulls_last())))
    mean = sum((F.col(r) for r in measures), F.lit(0)) / float(len(measures))
    out = out.withColumn(score, F.round(mean, 1))
    return out.withColumn(rank, F.dense_rank().over(Window.orderBy(F.col(score).asc_nulls_last())))


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    rank_col: str = "rnk") -> DataFrame:
    """Rows whose ``rank()`` within the group is <= n (ties kept)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= n)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Global top-k: Spark plans ``orderBy().limit()`` as TakeOrderedAndProject
    (per-partition heaps of k rows, merged), never a full sort."""
    return df.orderBy(*order).limit(k)


def rank_desc(df: DataFrame, measure: str, out: str) -> DataFrame:
    """rank() along one measure, descending (W7); ties share the smallest rank."""
    return df.withColumn(out, F.rank().over(Window.orderBy(F.col(measure).desc_nulls_last())))
