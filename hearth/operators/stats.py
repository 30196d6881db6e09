"""Exact quantiles, correlations, regression and standardisation.

``exact_quantiles`` computes linear-interpolation quantiles (the default of
pandas / numpy, ``percentile`` in Spark SQL, ``quantile_cont`` in DuckDB)
without gathering a group's values into one buffer or one task. It first
counts each distinct (group, value) — a partial aggregate, so duplicates
collapse on the map side — then takes a distributed running count over the
sorted distinct values (``operators.prefix.running_sum``: range partitions
and slice offsets, so a group with many distinct values spans many tasks)
and picks the two order statistics around the target rank with a
partial-aggregated max per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .prefix import running_sum


def exact_quantiles(df: DataFrame, groups: list[str], value: str, probs: dict[str, float],
                    extra: list | None = None, bounded: bool = False) -> DataFrame:
    """One row per group with a column per named probability; NULL values ignored.

    ``extra`` aggregates (e.g. a mean) are computed per group in the same
    call and joined on the group keys. ``bounded=True`` states that the
    number of distinct values per group is bounded by the domain (e.g. a
    score from 0 to 100, or one value per type of a fixed vocabulary): the
    running count then uses a plain window per group instead of the
    range-partitioned running sum, saving a checkpoint and two shuffles.
    """
    if not groups:
        # A global aggregate has exactly one row, even over empty input. The
        # quantile row (0 or 1 rows) and the extra aggregates (1 row) are
        # combined by a union and one more global aggregate — no join.
        q = exact_quantiles(df.withColumn("_g", F.lit(0)), ["_g"], value, probs, bounded=bounded).drop("_g")
        base = df.agg(*(extra or [F.count(F.lit(1)).alias("_n")]))
        qt, bt = dict(q.dtypes), dict(base.dtypes)
        left = base.select(*base.columns, *[F.lit(None).cast(qt[c]).alias(c) for c in q.columns])
        right = q.select(*[F.lit(None).cast(bt[c]).alias(c) for c in base.columns], *q.columns)
        cols = base.columns + q.columns
        out = left.unionByName(right).agg(*[F.max(c).alias(c) for c in cols])
        return out if extra else out.drop("_n")
    hist = (df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
            .groupBy(*groups, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    if bounded:
        w_run = Window.partitionBy(*groups).orderBy("_v").rowsBetween(Window.unboundedPreceding,
                                                                      Window.currentRow)
        walked = (hist.withColumn("_cum", F.sum("_c").over(w_run))
                  .withColumn("_n", F.sum("_c").over(Window.partitionBy(*groups))))
    else:
        cum = running_sum(hist, groups, [F.asc("_v")], "_c", "_cum")
        totals = cum.groupBy(*groups).agg(F.max("_cum").alias("_n"))
        walked = cum.join(totals, groups)
    walked = walked.withColumn("_prev", F.col("_cum") - F.col("_c"))
    aggs = []
    for name, p in probs.items():
        h = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        at = lambda k: (F.col("_prev") <= k) & (k < F.col("_cum"))
        aggs += [F.max(F.when(at(lo), F.col("_v"))).alias(f"{name}__lo"),
                 F.max(F.when(at(hi), F.col("_v"))).alias(f"{name}__hi"),
                 F.max(h - lo).alias(f"{name}__f")]
    picked = walked.groupBy(*groups).agg(*aggs)
    out = [F.col(g) for g in groups]
    for name in probs:
        lo_v, hi_v, frac = F.col(f"{name}__lo"), F.col(f"{name}__hi"), F.col(f"{name}__f")
        out.append((lo_v + (hi_v - lo_v) * frac).alias(name))
    result = picked.select(*out)
    if extra:
        result = df.groupBy(*groups).agg(*extra).join(result, groups, "left")
    return result


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair, as (x, y, r) rows, in one aggregate pass (M1)."""
    pairs = [(a, b) for a in cols for b in cols]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    long = wide.unpivot([], [f"{a}__{b}" for a, b in pairs], "pair", "r")
    return long.select(F.split("pair", "__")[0].alias("x"), F.split("pair", "__")[1].alias("y"), "r")


def regression_line(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares slope/intercept and r (M2)."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.corr(x, y).alias("r"), F.regr_count(y, x).alias("n"))


def standardise(df: DataFrame, cols: list[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / population std per column (M3, trap 17).

    The statistics are one fixed-size aggregate row (two numbers per column),
    fetched to the driver and applied as literals, so the scaling itself is a
    single map-side projection.
    """
    row = df.agg(*[F.avg(c).alias(f"{c}__mu") for c in cols],
                 *[F.stddev_pop(c).alias(f"{c}__sd") for c in cols]).first()
    out = df
    for c in cols:
        mu, sd = row[f"{c}__mu"], row[f"{c}__sd"]
        out = out.withColumn(f"{c}{suffix}", F.try_divide(F.col(c) - F.lit(mu), F.lit(sd)))
    return out
