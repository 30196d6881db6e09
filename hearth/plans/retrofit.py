"""Retrofit cost tables and breakdowns over recommendations ⋈ certificates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators.ranking import top_k, top_n_per_group
from . import gold
from . import layers

M = 1_000_000


def enriched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(silver certificates, recommendations ⋈ certificates with category, tier, age group) from the silver layer."""
    return layers.certificates(spark, sf_dir), layers.retrofit_base(spark, sf_dir)


def priority_areas(spark: SparkSession, sf_dir: str, silver: DataFrame, n: int = fixed.TOP_AREAS) -> DataFrame:
    """The top-n areas of the composite priority (ties broken by name); n rows at most."""
    pr = gold.composite_priority(spark, sf_dir, silver)
    return pr.orderBy("priority_rank", "borough").limit(n).select("borough")


def in_priority_areas(df: DataFrame, areas: DataFrame) -> DataFrame:
    """IN-list filter as a left-semi join to a bounded (n-row) broadcast side."""
    return df.join(F.broadcast(areas), "borough", "left_semi")


def per_property(joined: DataFrame, keys: list[str]) -> DataFrame:
    """Pre-aggregate to one row per (keys, certificate).

    Distinct-property counts then become plain counts of this table, which
    avoids Spark's Expand rewrite for ``count(distinct)`` mixed with sums and
    shrinks a hot area to one row per property before its final shuffle.
    """
    return joined.groupBy(*keys, "certificate_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("cost_low").alias("s_low"),
        F.sum("cost_mid").alias("s_mid"),
        F.sum("cost_high").alias("s_high"),
    )


ROLLUP_KEYS = ("borough", "improvement_type", "improvement_id", "category", "work_tier", "priority")
COSTS = ("low", "mid", "high")


def rollup(joined: DataFrame) -> DataFrame:
    """One row per area, type, category, tier and position: rows, and each cost's sum and number of values.

    Counts and sums add up, so every report without distinct properties is a small aggregate of this table.
    """
    return joined.groupBy(*ROLLUP_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"cost_{c}").alias(f"s_{c}") for c in COSTS],
        *[F.count(f"cost_{c}").alias(f"k_{c}") for c in COSTS])


def _rows(condition: Column | None = None) -> Column:
    return F.sum("n") if condition is None else F.sum(F.when(condition, F.col("n")).otherwise(0))


def _mean(cost: str = "mid") -> Column:
    return F.round(F.try_divide(F.sum(f"s_{cost}"), F.sum(f"k_{cost}")), 0)


def _millions(cost: str, digits: int) -> Column:
    return F.round(F.sum(f"s_{cost}") / M, digits)


def retrofit_costs(rolled: DataFrame) -> DataFrame:
    return rolled.groupBy("borough").agg(
        _rows().alias("total_recommendations"),
        _mean().alias("avg_cost_per_recommendation"),
        _millions("mid", 2).alias("total_indicative_cost_m"),
    )


def retrofit_scenarios(joined: DataFrame) -> DataFrame:
    pp = per_property(joined, ["borough"])
    agg = pp.groupBy("borough").agg(
        F.sum("n").alias("total_recommendations"),
        F.count(F.lit(1)).alias("properties_with_recs"),
        F.sum("s_low").alias("s_low"), F.sum("s_mid").alias("s_mid"), F.sum("s_high").alias("s_high"),
    )
    homes = F.col("properties_with_recs")
    return agg.select(
        "borough", "total_recommendations", "properties_with_recs",
        F.round(F.col("s_low") / M, 2).alias("total_optimistic_m"),
        F.round(F.col("s_mid") / M, 2).alias("total_central_m"),
        F.round(F.col("s_high") / M, 2).alias("total_pessimistic_m"),
        F.round(F.col("s_low") / homes, 0).alias("per_home_optimistic"),
        F.round(F.col("s_mid") / homes, 0).alias("per_home_central"),
        F.round(F.col("s_high") / homes, 0).alias("per_home_pessimistic"),
        F.round(F.try_divide(F.col("s_high") - F.col("s_low"), F.col("s_mid")) * 100, 1).alias("uncertainty_pct"),
    )


def wall_split(rolled: DataFrame) -> DataFrame:
    walls = rolled.groupBy("borough").agg(
        _rows().alias("total_recs"),
        _rows(F.col("improvement_id") == fixed.CAVITY_WALL_ID).alias("cavity_wall_recs"),
        _rows(F.col("improvement_id") == fixed.SOLID_WALL_ID).alias("solid_wall_recs"),
    ).withColumn("total_wall_recs", F.col("cavity_wall_recs") + F.col("solid_wall_recs"))
    return walls.filter(F.col("total_wall_recs") > 0).select("*", *[
        F.round(F.col(f"{kind}_wall_recs") / F.col("total_wall_recs") * 100, 1).alias(f"pct_{kind}_wall")
        for kind in ("solid", "cavity")])


def type_stats(rolled: DataFrame, keys=("improvement_type",)) -> DataFrame:
    return rolled.groupBy(*keys).agg(_rows().alias("times_recommended"), _mean().alias("avg_cost"))


def common_types(rolled: DataFrame, k: int = 20) -> DataFrame:
    return top_k(type_stats(rolled), [F.desc("times_recommended"), F.asc_nulls_last("improvement_type")], k)


def expensive_types(rolled: DataFrame, k: int = 15, min_count: int = 100) -> DataFrame:
    st = type_stats(rolled).filter(F.col("times_recommended") > min_count)
    return top_k(st, [F.desc("avg_cost"), F.asc_nulls_last("improvement_type")], k)


def cost_range_by_type(rolled: DataFrame, k: int = 20, min_count: int = 100) -> DataFrame:
    st = rolled.groupBy("improvement_type").agg(
        _rows().alias("times_recommended"), *[_mean(c).alias(f"avg_{c}") for c in COSTS],
    ).filter(F.col("times_recommended") > min_count)
    return top_k(st, [F.desc("avg_mid"), F.asc_nulls_last("improvement_type")], k)


def wall_share_by_area(rolled: DataFrame) -> DataFrame:
    return rolled.groupBy("borough").agg(
        _rows().alias("total_recs"),
        _rows(F.col("improvement_type").rlike("(?i)wall insulation")).alias("wall_insulation_recs"),
    ).withColumn("pct_needing_wall_insulation",
                 F.round(F.col("wall_insulation_recs") / F.col("total_recs") * 100, 1))


def priority_scenarios(joined: DataFrame, areas: DataFrame) -> DataFrame:
    pp = per_property(in_priority_areas(joined, areas), ["borough"])
    agg = pp.groupBy("borough").agg(
        F.count(F.lit(1)).alias("properties"),
        F.sum("s_low").alias("s_low"), F.sum("s_mid").alias("s_mid"), F.sum("s_high").alias("s_high"))
    h = F.col("properties")
    return agg.select(
        "borough", "properties",
        F.round(F.col("s_low") / h, 0).alias("per_home_low"),
        F.round(F.col("s_mid") / h, 0).alias("per_home_mid"),
        F.round(F.col("s_high") / h, 0).alias("per_home_high"),
        F.round(F.col("s_low") / M, 2).alias("total_low_m"),
        F.round(F.col("s_mid") / M, 2).alias("total_mid_m"),
        F.round(F.col("s_high") / M, 2).alias("total_high_m"),
    )


def category_costs(rolled: DataFrame) -> DataFrame:
    return rolled.groupBy("category").agg(
        _rows().alias("recommendations"),
        _mean().alias("avg_cost_per_rec"),
        _millions("mid", 1).alias("total_cost_m"),
        _millions("low", 1).alias("total_low_m"),
        _millions("high", 1).alias("total_high_m"),
    )


def area_category_costs(rolled: DataFrame, areas: DataFrame) -> DataFrame:
    return in_priority_areas(rolled, areas).groupBy("borough", "category").agg(
        _rows().alias("recs"), _millions("mid", 2).alias("cost_m"))


def work_tiers(rolled: DataFrame) -> DataFrame:
    return rolled.groupBy("work_tier").agg(
        _rows().alias("recommendations"), _mean().alias("avg_cost"), _millions("mid", 1).alias("total_cost_m"))


def tier_share_by_area(joined: DataFrame) -> DataFrame:
    quick = F.col("work_tier") == fixed.QUICK_WIN
    pp = joined.groupBy("borough", "certificate_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(quick, 1).otherwise(0)).alias("n_quick"),
        F.sum("cost_mid").alias("s_mid"))
    agg = pp.groupBy("borough").agg(
        F.sum("n").alias("total_recs"), F.sum("n_quick").alias("n_quick"),
        F.count(F.lit(1)).alias("homes"), F.sum("s_mid").alias("s_mid"))
    return agg.select(
        "borough", "total_recs",
        F.round(F.col("n_quick") / F.col("total_recs") * 100, 1).alias("pct_quick_wins"),
        F.round((F.col("total_recs") - F.col("n_quick")) / F.col("total_recs") * 100, 1).alias("pct_major_works"),
        F.round(F.col("s_mid") / F.col("homes"), 0).alias("cost_per_home"),
    )


def quick_win_detail(rolled: DataFrame, areas: DataFrame) -> DataFrame:
    return (in_priority_areas(rolled, areas)
            .filter(F.col("work_tier") == fixed.QUICK_WIN)
            .groupBy("borough", "work_tier", "improvement_type")
            .agg(_rows().alias("recs"), _mean().alias("avg_cost")))


def first_ranked_types(rolled: DataFrame, k: int = 15) -> DataFrame:
    st = (rolled.filter(F.col("priority") == 1)
          .groupBy("improvement_type", "category")
          .agg(_rows().alias("times_top_priority"), _mean().alias("avg_cost")))
    return top_k(st, [F.desc("times_top_priority"), F.asc_nulls_last("improvement_type")], k)


def top3_first_ranked(rolled: DataFrame, areas: DataFrame, n: int = 3) -> DataFrame:
    st = (in_priority_areas(rolled.filter(F.col("priority") == 1), areas)
          .groupBy("borough", "improvement_type", "category").agg(_rows().alias("times_top")))
    return top_n_per_group(st, ["borough"], [F.desc("times_top")], n)


def cost_by_position(rolled: DataFrame, max_position: int = 10) -> DataFrame:
    return (rolled.filter(F.col("priority") <= max_position)
            .groupBy("priority").agg(_rows().alias("recommendations"), _mean().alias("avg_cost")))


def avg_cost_priority(rolled: DataFrame, areas: DataFrame) -> DataFrame:
    return in_priority_areas(rolled, areas).groupBy("borough").agg(_mean().alias("avg_cost_per_rec"))


def top5_types_per_area(rolled: DataFrame, areas: DataFrame, n: int = 5) -> DataFrame:
    st = type_stats(in_priority_areas(rolled, areas), ("borough", "improvement_type"))
    return top_n_per_group(st, ["borough"], [F.desc("times_recommended")], n)
