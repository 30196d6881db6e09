"""Bounded samples of labelled documents, for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int) -> DataFrame:
    """``(doc_id, text, y)`` of up to ``max_rows`` labelled documents where ``learn`` holds, half of each class if there are as many.

    Only ids and labels are ranked (by a hash of the id); the chosen ids, ``max_rows`` at most, are sent to the
    scan of the texts. An id labelled twice counts with its lower label.
    """
    known = labels.where(learn & F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(label).cast("int").alias("y"))
    half = max_rows // 2
    chosen = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half).select("doc_id", F.lit(y).alias("y")) for y in (0, 1)]
    return docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").select("doc_id", "text", "y")


def base_rate(labels: DataFrame, label: str, learn: Column) -> float:
    """Share of label 1 among the rows to learn from; 0.5 without any."""
    n, ones = labels.where(learn & F.col(label).isNotNull()).agg(F.count(F.lit(1)), F.sum(F.col(label).cast("long"))).first()
    return min(max((ones or 0) / n, 1e-3), 1 - 1e-3) if n else 0.5
