"""Profiling operators: value frequencies and column audits.

The reference audits one column per Spark job (a filter + count per column).
Here each audit is a single aggregate pass over the table; the per-column
results are then unpivoted into rows (the aggregate has one row, so the
unpivot is free).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Frequency table of one column, most frequent first (ties by value); NULL kept."""
    vc = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    ordered = vc.orderBy(F.desc("count"), F.asc_nulls_last("value"))
    return ordered.limit(n) if n else ordered


def multi_value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, count) for several columns in one pass.

    Each row is unpivoted into one (column, value) pair per column; the
    partial aggregate collapses the pairs per partition before the shuffle,
    so the shuffle carries distinct pairs only.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("p")).select("p.*")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def _is_float(dtype) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def null_audit(df: DataFrame) -> DataFrame:
    """NULL count per column (NaN counted for floating columns) in one pass."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        bad = c.isNull() | F.isnan(c) if _is_float(f.dataType) else c.isNull()
        exprs.append(F.count_if(bad).alias(f.name))
    wide = df.agg(*exprs)
    return wide.unpivot([], [f.name for f in df.schema.fields], "column_name", "nulls")


def blank_audit(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL-or-blank count and share per column in one pass (A27); NULL for a column that is not there."""
    columns = columns or df.columns
    exprs = [F.count_if(F.col(f"`{c}`").isNull() | (F.trim(F.col(f"`{c}`").cast("string")) == "")).alias(c)
             if c in df.columns else F.lit(None).cast("long").alias(c) for c in columns]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *exprs)
    long = wide.unpivot(["_rows"], columns, "column_name", "blanks")
    return long.select("column_name", "blanks",
                       F.round(F.col("blanks") / F.col("_rows") * 100, 1).alias("pct_blank"))


def share_of_total(counts: DataFrame, count_col: str = "count", out: str = "pct_of_total") -> DataFrame:
    """Add each row's share of the column total. Used on small frequency
    tables only: the empty window runs in one task."""
    return counts.withColumn(out, F.round(F.col(count_col) / F.sum(count_col).over(Window.partitionBy()) * 100, 1))


def distinct_counts(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One row: the distinct non-null values of each of ``columns`` (name -> expression), exact.

    Several ``count(distinct)`` in one aggregate copy every row before the shuffle. Here the (column, value) pairs are
    added up to distinct ones in the scan's tasks, and these are counted: what is shuffled is bounded by the values.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), c.cast("string").alias("value")) for i, c in enumerate(columns.values())])
    distinct = df.select(F.inline(pairs)).where("value is not null").groupBy("i", "value").agg(F.lit(1).alias("one"))
    return distinct.agg(*[F.count_if(F.col("i") == i).alias(name) for i, name in enumerate(columns)])
