"""Latest record per key (W1/U3) and dedup statistics.

``row_number() = 1`` per key, newest first. Spark cuts each key to one row in the
scan's tasks before anything is shuffled (a partial group limit), so a key that
holds a third of the data is one row a task by then, and the shuffle carries at
most one row per key and partition. Against an aggregate of the whole row
(``max_by`` of a struct), which is planned as two sorts of packed rows, no row is
packed and unpacked.

A NULL date is older than every date, and ties on date fall back to the larger id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import _c


def property_key(uprn: str = "uprn", postcode: str = "postcode", address: str = "address1",
                 fallback_id: str = "certificate_id") -> Column:
    """Dedup key: non-blank uprn, else 'postcode|address1' (C10).

    When postcode and address are both missing the reference's key is '' for
    all such rows, collapsing unrelated properties into one; we key those rows
    by their own id instead (trap 11) — this also removes a giant skewed group.
    """
    u, p, a = F.col(uprn), F.col(postcode), F.col(address)
    blank = lambda c: c.isNull() | (c == "")
    return F.coalesce(
        F.when(~blank(u), u),
        F.when(blank(p) & blank(a), F.col(fallback_id)),
        F.concat_ws("|", p, a),
    )


def latest_per_key(df: DataFrame, key: Column | str, order_cols: list[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_cols`` (NULLs lowest)."""
    newest_first = Window.partitionBy(_c(key)).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return df.withColumn("_newest", F.row_number().over(newest_first)).where("_newest = 1").drop("_newest")


def dedup_stats(df: DataFrame, key: Column | str) -> DataFrame:
    """Rows before/after dedup in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_distinct(_c(key)).alias("rows_after"),
    ).select(
        "rows_before", "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        F.round(F.try_divide(F.col("rows_before") - F.col("rows_after"), F.col("rows_before")) * 100, 1)
        .alias("pct_removed"),
    )
