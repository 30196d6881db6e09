"""Reachability of the target score and the greedy cheapest cover.

The greedy step, per property below the target that the assessor says can
reach it: look up an estimated uplift for each of its recommendations
(by type and age group, else by type, else a global median), order them by
cost per point (cheapest first), accumulate uplift, and select up to the
first recommendation at which the running total covers the gap.

The running total is a distributed prefix sum (``operators.prefix``):
range partitions over (certificate, greedy order) with per-slice offsets,
so even a certificate with very many rows is spread over many tasks. Uplift
is carried in exact integer hundredths (the estimates are rounded to 2 dp),
so the running sum and the ``>= gap`` test are exact and independent of
summation order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..operators.prefix import running_sum
from ..operators.stats import exact_quantiles
from ..session import durable
from . import layers

T = fixed.TARGET_SCORE
CAP = fixed.EXEMPT_CAP


def age_column(group: str) -> str:
    """Column name for an age group: lower-case, '+' -> 'plus', other symbols -> '_'."""
    return "age_" + re.sub(r"[^a-z0-9]+", "_", group.lower().replace("+", "_plus")).strip("_")


AGE_COLUMNS = [age_column(g) for g in fixed.AGE_ORDER]


def scored(silver: DataFrame) -> DataFrame:
    """Certificates with a score, plus age group, gap to target and reachability."""
    score, pot = F.col("epc_score"), F.col("epc_potential")
    return (silver.filter(score.isNotNull())
            .withColumn("age_group", C.age_group("construction_age_band"))
            .withColumn("below_target", score < T)
            .withColumn("gap", F.when(score < T, F.lit(T) - score))
            .withColumn("epc_reachable", pot.isNotNull() & (pot >= T)))


def below_target(silver: DataFrame) -> DataFrame:
    return scored(silver).filter(F.col("below_target"))


def funnel(silver: DataFrame) -> DataFrame:
    s = scored(silver)
    below, reach = F.col("below_target"), F.col("below_target") & F.col("epc_reachable")
    n = F.count(F.lit(1))
    return s.agg(
        n.alias("total"),
        F.count_if(~below).alias("at_target"),
        F.count_if(below).alias("below"),
        F.count_if(reach).alias("reachable"),
        F.count_if(below & ~F.col("epc_reachable")).alias("not_reachable"),
        F.round(F.try_divide(F.count_if(~below), n) * 100, 1).alias("pct_at_target"),
        F.round(F.try_divide(F.count_if(below), n) * 100, 1).alias("pct_below"),
        F.round(F.try_divide(F.count_if(reach), F.count_if(below)) * 100, 1).alias("pct_reachable"),
    )


def gap_percentiles(silver: DataFrame) -> DataFrame:
    # gaps are whole points below the target score: at most TARGET_SCORE distinct values
    below = below_target(silver).withColumn("gap", F.round("gap").cast("int"))
    q = exact_quantiles(below, [], "gap", {"median_gap": 0.5, "p90_gap": 0.9},
                        extra=[F.round(F.avg("gap"), 1).alias("mean_gap"), F.count(F.lit(1)).alias("n")],
                        bounded=True)
    return q.select("n", "mean_gap", F.round("median_gap", 2).alias("median_gap"),
                    F.round("p90_gap", 2).alias("p90_gap"))


def age_distribution(silver: DataFrame) -> DataFrame:
    return (below_target(silver).groupBy("age_group").agg(
        F.count(F.lit(1)).alias("n_properties"),
        F.round(F.avg(F.col("epc_reachable").cast("double")) * 100, 1).alias("pct_reachable"),
        F.round(F.avg("gap"), 1).alias("avg_gap"))
        .withColumn("display_order", C.age_group_order("age_group")))


# ------------------------------------------------------------------ recommendation side

def scored_recs(spark: SparkSession, sf_dir: str, silver: DataFrame | None = None) -> DataFrame:
    """Recommendations ⋈ certificates with age group, from the silver layer."""
    return layers.retrofit_base(spark, sf_dir)


def frequent_types(recs: DataFrame, min_freq: int = fixed.MIN_TYPE_FREQ) -> DataFrame:
    """Improvement types with at least ``min_freq`` recommendation rows (A37, trap 19)."""
    return (recs.filter(F.col("improvement_type").isNotNull())
            .groupBy("improvement_type").agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") >= min_freq))


def type_property_counts(recs: DataFrame) -> DataFrame:
    """Distinct below-target properties per type."""
    return (recs.filter((F.col("epc_score") < T) & F.col("improvement_type").isNotNull())
            .select("improvement_type", "certificate_id").distinct()
            .groupBy("improvement_type").agg(F.count(F.lit(1)).alias("n_properties")))


def presence(recs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Distinct (certificate, frequent type) pairs: the multi-hot matrix in long form.

    ``frequent`` is one row per type; Spark broadcasts it by its size.
    """
    return (recs.join(frequent.select("improvement_type"), "improvement_type", "left_semi")
            .select("certificate_id", "improvement_type").distinct())


def uplift_attribution(recs: DataFrame, silver: DataFrame, min_freq: int = fixed.MIN_TYPE_FREQ,
                       min_rows: int = fixed.MIN_PRESENT_ROWS) -> DataFrame:
    """Per-type estimated uplift, overall and per age group (A40 shape), long form.

    SQL-expressible estimate: each property's assessed uplift (potential -
    current, >= 0) is shared equally among the frequent types recommended
    for it; a type's estimate is the mean share over properties where it is
    present. Shares and means are kept in whole hundredths of a point
    (rounded half up), so every sum is an exact integer and the 2-dp result
    does not depend on summation order. Types present on fewer than
    ``min_rows`` properties are dropped. Returns (improvement_type,
    age_group, avg_pts, overall_avg_pts, n_present).
    """
    pres = presence(recs, frequent_types(recs, min_freq))
    k = pres.groupBy("certificate_id").agg(F.count(F.lit(1)).alias("k"))
    certs = (silver.filter(F.col("epc_score").isNotNull() & F.col("epc_potential").isNotNull())
             .withColumn("uplift", F.col("epc_potential") - F.col("epc_score"))
             .filter(F.col("uplift") >= 0)
             .select("certificate_id", "uplift", C.age_group("construction_age_band").alias("age_group")))
    shares = (pres.join(k, "certificate_id").join(certs, "certificate_id")
              .withColumn("share_c", F.round(F.col("uplift") * 100 / F.col("k"), 0).cast("long")))
    by_age = shares.groupBy("improvement_type", "age_group").agg(
        F.sum("share_c").alias("s"), F.count(F.lit(1)).alias("c"))
    overall = by_age.groupBy("improvement_type").agg(
        (F.round(F.sum("s") / F.sum("c"), 0) / 100).alias("overall_avg_pts"),
        F.sum("c").alias("n_present")).filter(F.col("n_present") >= min_rows)
    return (by_age.join(overall, "improvement_type")
            .select("improvement_type", "age_group",
                    (F.round(F.col("s") / F.col("c"), 0) / 100).alias("avg_pts"),
                    "overall_avg_pts", "n_present"))


def attribution_table(long: DataFrame, recs: DataFrame) -> DataFrame:
    """Wide table: improvement_type, overall_avg_pts, n_properties, one column per age group.

    The pivot values are the fixed age groups, so no extra pass is needed to
    discover them.
    """
    wide = (long.filter(F.col("age_group").isin(*fixed.AGE_ORDER))
            .groupBy("improvement_type")
            .pivot("age_group", list(fixed.AGE_ORDER)).agg(F.first("avg_pts")))
    for g in fixed.AGE_ORDER:
        wide = wide.withColumnRenamed(g, age_column(g))
    base = long.select("improvement_type", "overall_avg_pts").distinct()
    return (base.join(wide, "improvement_type", "left")
            .join(type_property_counts(recs), "improvement_type", "left")
            .select("improvement_type", "overall_avg_pts",
                    F.coalesce("n_properties", F.lit(0)).alias("n_properties"), *AGE_COLUMNS))


def cost_efficiency(attr_wide: DataFrame, recs: DataFrame) -> DataFrame:
    """Attribution ⟕ mean costs -> £ per point (low/mid/high) and formatted ranges."""
    costs = recs.groupBy("improvement_type").agg(
        F.avg("cost_low").alias("cost_low"), F.avg("cost_mid").alias("cost_mid"),
        F.avg("cost_high").alias("cost_high"))
    ce = (attr_wide.select("improvement_type", "overall_avg_pts", "n_properties")
          .join(costs, "improvement_type", "left")
          .filter(F.col("overall_avg_pts") > 0))
    pts = F.col("overall_avg_pts")
    ce = (ce.withColumn("per_point_mid", F.round(F.col("cost_mid") / pts, 0))
          .withColumn("per_point_low", F.round(F.col("cost_low") / pts, 0))
          .withColumn("per_point_high", F.round(F.col("cost_high") / pts, 0))
          .withColumn("cost_range", C.money_range("cost_mid", "cost_low", "cost_high"))
          .withColumn("per_point_range", C.money_range("per_point_mid", "per_point_low", "per_point_high"))
          .withColumn("cost_low", F.round("cost_low", 2))
          .withColumn("cost_mid", F.round("cost_mid", 2))
          .withColumn("cost_high", F.round("cost_high", 2)))
    return ce.orderBy(F.asc_nulls_last("per_point_mid"), F.asc("improvement_type"))


# ------------------------------------------------------------------ greedy cover

def uplift_lookup(long: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(by type+age, by type, global median) lookups; only positive values kept."""
    by_age = (long.filter(F.col("avg_pts") > 0)
              .select("improvement_type", "age_group", F.col("avg_pts").alias("u_age")))
    types = long.select("improvement_type", "overall_avg_pts").distinct()
    by_type = (types.filter(F.col("overall_avg_pts") > 0)
               .select("improvement_type", F.col("overall_avg_pts").alias("u_type")))
    glob = exact_quantiles(types, [], "overall_avg_pts", {"u_global": 0.5}, bounded=True)  # one row per type
    return by_age, by_type, glob


def greedy_candidates(recs: DataFrame, long: DataFrame) -> DataFrame:
    """Reachable below-target recommendations with estimated uplift and cost per point.

    The lookups hold a row per type (x age group); Spark broadcasts them by
    their size. The global fallback is a single number.
    """
    by_age, by_type, glob = uplift_lookup(long)
    # The global fallback is one number (median over the type vocabulary): fetched once.
    u_global = glob.first()["u_global"]
    cand = (recs.filter((F.col("epc_score") < T) & (F.col("epc_potential") >= T))
            .withColumn("gap", F.lit(T) - F.col("epc_score")))
    return (cand.join(by_age, ["improvement_type", "age_group"], "left")
            .join(by_type, "improvement_type", "left")
            .withColumn("est_uplift", F.coalesce("u_age", "u_type", F.lit(u_global).cast("double")))
            .withColumn("est_c", F.round(F.col("est_uplift") * 100).cast("long"))
            .withColumn("cost_per_pt",
                        F.when((F.col("est_uplift") > 0) & F.col("cost_mid").isNotNull(),
                               F.col("cost_mid") / F.col("est_uplift"))
                        .otherwise(F.lit(float("inf")))))


def greedy_order() -> list:
    """Order of a certificate's recommendations: cheapest per point first, then fixed tie-breaks."""
    return [F.asc("cost_per_pt"), F.asc_nulls_last("improvement_type"), F.asc_nulls_last("priority"),
            F.asc_nulls_last("cost_low"), F.asc_nulls_last("cost_high")]


def greedy_rows(recs: DataFrame, long: DataFrame, partitions: int | None = None) -> DataFrame:
    """Candidates with their running uplift, and what each adds to its slice's part of the cover.

    The running uplift per certificate comes from ``running_sum`` (range
    partitions + slice offsets), so a certificate with very many rows is
    spread over several tasks. ``covers`` says whether the gap is covered with
    this row, ``open`` whether no earlier row of the same slice covers it.
    Rows equal in every sort column carry equal uplift and cost, so their
    relative order does not change the selected totals. Only the columns that
    the cover reads are moved.
    """
    est = greedy_candidates(recs, long).select("certificate_id", "improvement_type", "priority", "cost_low", "cost_mid", "cost_high",
                                               "gap", "est_c", "cost_per_pt")
    local = running_sum(est, ["certificate_id"], greedy_order(), "est_c", "cum_c", partitions)
    earlier = Window.partitionBy("certificate_id", "_p").orderBy("_rn").rowsBetween(Window.unboundedPreceding, -1)
    return (local.withColumn("covers", F.coalesce(F.col("cum_c") >= F.col("gap") * 100, F.lit(False)))
            .withColumn("open", ~F.coalesce(F.max("covers").over(earlier), F.lit(False))))


def greedy_results(rows: DataFrame) -> DataFrame:
    """Per certificate with candidates: whether they cover its gap, and the selected set's cost sums and size.

    Rows are added up by (certificate, slice), as they lie; only these sums,
    one for most certificates, meet by certificate. The selected set is the
    open rows of all slices up to the first one that covers the gap.
    """
    costs = ("low", "mid", "high")
    pick = lambda c: F.when(F.col("open"), F.col(c))
    slices = rows.groupBy("certificate_id", "_p").agg(
        F.max("covers").alias("covers"), F.count(pick("improvement_type")).alias("n"),
        *[F.sum(pick(f"cost_{c}")).alias(c) for c in costs])
    earlier = Window.partitionBy("certificate_id").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return (slices.withColumn("done", F.coalesce(F.max("covers").over(earlier), F.lit(False))).where(~F.col("done"))
            .groupBy("certificate_id").agg(
                F.max("covers").alias("covered"),
                *[F.coalesce(F.sum(c), F.lit(0.0)).alias(f"greedy_cost_{c}") for c in costs],
                F.sum("n").alias("n_recs_needed")))


def greedy_cover(results: DataFrame) -> DataFrame:
    """The covered certificates with their selected set's cost sums and size (A42, trap 20)."""
    return results.where("covered").drop("covered")


def greedy_headline(greedy: DataFrame) -> DataFrame:
    q = exact_quantiles(greedy, [], "greedy_cost_mid", {"median_cost_mid": 0.5}, extra=[
        F.count(F.lit(1)).alias("n_covered"),
        F.round(F.avg("greedy_cost_mid"), 0).alias("mean_cost_mid"),
        F.round(F.try_divide(F.count_if(F.col("greedy_cost_mid") > CAP), F.count(F.lit(1))) * 100, 1)
        .alias("pct_over_cap"),
        F.round(F.avg("n_recs_needed"), 1).alias("avg_recs")])
    return q.withColumn("median_cost_mid", F.round("median_cost_mid", 0))


def property_classes(silver: DataFrame, results: DataFrame) -> DataFrame:
    """Below-target properties ⟕ greedy result -> 5-way class."""
    only_covered = [F.when(F.col("covered"), F.col(c)).alias(c) for c in
                    ("greedy_cost_low", "greedy_cost_mid", "greedy_cost_high", "n_recs_needed")]
    g = results.select("certificate_id", F.col("covered").alias("has_greedy"), F.lit(True).alias("has_recs"), *only_covered)
    p = below_target(silver).join(g, "certificate_id", "left").fillna(False, ["has_greedy", "has_recs"])
    cls = fixed.PROPERTY_CLASSES
    return p.withColumn("category",
                        F.when(~F.col("epc_reachable"), cls[0])
                        .when(~F.col("has_recs"), cls[1])
                        .when(~F.col("has_greedy"), cls[2])
                        .when(F.col("greedy_cost_mid") > CAP, cls[3])
                        .otherwise(cls[4]))


def area_greedy_summary(silver: DataFrame, props: DataFrame) -> DataFrame:
    """Per area: counts, shares, average gap, exact median costs and a formatted range."""
    agg = props.groupBy("borough").agg(
        F.count(F.lit(1)).alias("below_c"),
        F.count_if(F.col("epc_reachable")).alias("n_epc_reachable"),
        F.count_if(F.col("greedy_cost_mid") > CAP).alias("n_over_10k"),
        F.round(F.avg("gap"), 1).alias("avg_gap"),
        F.round(F.avg("n_recs_needed"), 1).alias("avg_recs_to_c"))
    # the three medians in one pass over (area, measure, value)
    kinds = ("low", "mid", "high")
    long = props.select("borough", F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(f"greedy_cost_{c}").alias("v")) for c in kinds])).alias("e")
    ).select("borough", "e.*")
    q = exact_quantiles(long, ["borough", "measure"], "v", {"median": 0.5})
    med = (q.groupBy("borough").pivot("measure", list(kinds)).agg(F.first("median"))
           .toDF("borough", *[f"median_cost_{c}" for c in kinds]))
    at_c = (scored(silver).filter(~F.col("below_target")).groupBy("borough")
            .agg(F.count(F.lit(1)).alias("already_at_c")))
    out = (agg.join(med, "borough", "left").join(at_c, "borough", "left")
           .withColumn("pct_reachable", F.round(F.col("n_epc_reachable") / F.col("below_c") * 100, 1))
           .withColumn("pct_over_10k",
                       F.round(F.try_divide(F.col("n_over_10k"), F.nullif("n_epc_reachable", F.lit(0))) * 100, 1)))
    for c in ("low", "mid", "high"):
        out = out.withColumn(f"median_cost_{c}", F.round(f"median_cost_{c}", 0))
    return out.withColumn("cost_range", C.money_range("median_cost_mid", "median_cost_low", "median_cost_high"))


def reachability_shares(silver: DataFrame) -> DataFrame:
    """Per area: already at target / can reach / cannot reach, as shares summing to 100.

    One grouped pass with conditional counts replaces the three series and
    full outer joins; missing parts are 0 by construction.
    """
    s = scored(silver)
    below = F.col("below_target")
    agg = s.groupBy("borough").agg(
        F.count_if(~below).alias("already_c"),
        F.count_if(below & F.col("epc_reachable")).alias("can_reach"),
        F.count_if(below & ~F.col("epc_reachable")).alias("cannot_reach"),
        F.count(F.lit(1)).alias("total"))
    tot = F.col("total")
    return agg.select("borough", "already_c", "can_reach", "cannot_reach", "total",
                      (F.col("already_c") / tot * 100).alias("pct_already_c"),
                      (F.col("can_reach") / tot * 100).alias("pct_can_reach"),
                      (F.col("cannot_reach") / tot * 100).alias("pct_cannot_reach"))


def age_cost_stats(props: DataFrame) -> DataFrame:
    """Per age group, over reachable properties with a greedy result: % within cap, median cost."""
    p = props.filter(F.col("epc_reachable") & F.col("has_greedy") & F.col("age_group").isin(*fixed.AGE_ORDER))
    agg = p.groupBy("age_group").agg(
        F.round(F.avg((F.col("greedy_cost_mid") <= CAP).cast("double")) * 100, 1).alias("pct_within_10k"))
    med = exact_quantiles(p, ["age_group"], "greedy_cost_mid", {"median_cost_mid": 0.5})
    return (agg.join(med, "age_group")
            .withColumn("median_cost_mid", F.round("median_cost_mid", 2))
            .withColumn("display_order", C.age_group_order("age_group")))


def greedy_tables(spark: SparkSession, sf_dir: str, with_props: bool = True):
    """(silver, recs, attribution long, property classes, or the covered certificates without ``with_props``).

    The attribution table (bounded by types x age groups) is checkpointed into
    the shared checkpoint folder: three lookups read it. The property table
    is built only when asked for and then checkpointed too, since the area
    summary reads it four times.
    """
    silver = layers.homes(spark, sf_dir)
    recs = scored_recs(spark, sf_dir)
    long = durable(uplift_attribution(recs, silver))
    results = greedy_results(greedy_rows(recs, long))
    if with_props:
        return silver, recs, long, durable(property_classes(silver, results))
    return silver, recs, long, greedy_cover(results)
