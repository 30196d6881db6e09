"""Gold area tables: area quality, area deprivation, composite priority, trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..operators.ranking import composite_rank
from ..sources import bronze
from . import layers


def area_quality(silver: DataFrame) -> DataFrame:
    """Certificates -> one row per area (A2)."""
    return silver.groupBy("borough").agg(
        F.count(F.lit(1)).alias("social_properties"),
        F.round(F.avg("epc_score"), 1).alias("avg_epc_score"),
        C.pct(F.col("below_epc_c")).alias("pct_below_epc_c"),
        C.pct(C.pre_1950_flag("construction_age_band")).alias("pct_pre_1950"),
        F.round(F.avg("co2_emissions"), 2).alias("avg_co2_per_m2"),
    )


def area_deprivation(raw_imd: DataFrame) -> DataFrame:
    """Small areas -> one row per area with 5 rounded averages."""
    return (
        raw_imd.filter(F.col(f"`{bronze.IMD_CODE}`").startswith(fixed.AREA_CODE_PREFIX))
        .groupBy(F.col(f"`{bronze.IMD_NAME}`").alias("la_name"))
        .agg(
            F.round(F.avg(f"`{bronze.IMD_SCORE}`"), 3).alias("imd_score"),
            F.round(F.avg(f"`{bronze.IMD_INCOME}`"), 4).alias("income_deprivation_rate"),
            F.round(F.avg(f"`{bronze.IMD_EMPLOY}`"), 4).alias("employment_deprivation_rate"),
            F.round(F.avg(f"`{bronze.IMD_HEALTH}`"), 3).alias("health_deprivation_score"),
            F.round(F.avg(f"`{bronze.IMD_LIVING}`"), 3).alias("living_env_score"),
            F.count(F.lit(1)).alias("lsoa_count"),
        )
    )


def _keyed(quality: DataFrame, deprivation: DataFrame):
    return (quality.withColumn("area_key", C.norm_key("borough")),
            deprivation.withColumn("area_key", C.norm_key("la_name")))


PRIORITY_COLUMNS = (
    "priority_rank", "borough", "priority_score", "pct_below_epc_c", "income_deprivation_rate",
    "pct_pre_1950", "avg_epc_score", "imd_score", "employment_deprivation_rate",
    "health_deprivation_score", "living_env_score", "avg_co2_per_m2", "social_properties",
    "rank_epc", "rank_income", "rank_age",
)


def composite_priority_from(quality: DataFrame, deprivation: DataFrame) -> DataFrame:
    """Area quality ⋈ deprivation on a normalised name (J2) -> composite dense rank.

    Both inputs are already one row per area (bounded by the number of
    areas), so the join and the unpartitioned rank windows run on tiny data.
    """
    q, d = _keyed(quality, deprivation)
    joined = q.join(d, "area_key", "inner").drop("area_key", "la_name")
    ranked = composite_rank(joined, {
        "rank_epc": "pct_below_epc_c",
        "rank_income": "income_deprivation_rate",
        "rank_age": "pct_pre_1950",
    })
    return ranked.select(*PRIORITY_COLUMNS)


def composite_priority(spark: SparkSession, sf_dir: str, silver: DataFrame | None = None) -> DataFrame:
    silver = silver if silver is not None else layers.homes(spark, sf_dir)
    return composite_priority_from(area_quality(silver),
                                   area_deprivation(bronze.raw_deprivation(spark, sf_dir)))


def unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of the certificates with no deprivation match."""
    q, d = _keyed(area_quality(layers.homes(spark, sf_dir)),
                  area_deprivation(bronze.raw_deprivation(spark, sf_dir)))
    return q.join(d, "area_key", "left_anti").select("borough", "social_properties")


def top_area_trend(spark: SparkSession, sf_dir: str, top: int = fixed.TOP_AREAS) -> DataFrame:
    """Quality trend per (top-N priority area, year).

    The reference collects the top-5 names to the driver and splices them
    into an IN list. Here the top-N stays a DataFrame and filters by a
    left-semi join: it is bounded to N rows (plus ties broken by name), so
    Spark broadcasts it and can prune partitions of a borough-partitioned
    silver table at run time.
    """
    silver = layers.certificates(spark, sf_dir)
    priority = composite_priority(spark, sf_dir, silver)
    top_n = priority.orderBy("priority_rank", "borough").limit(top).select("borough")
    lo, hi = fixed.TREND_YEARS
    return (
        silver.filter(F.col("inspection_year").between(lo, hi))
        .join(F.broadcast(top_n), "borough", "left_semi")
        .groupBy("borough", "inspection_year")
        .agg(
            F.count(F.lit(1)).alias("inspections"),
            F.round(F.avg("epc_score"), 1).alias("avg_epc_score"),
            C.pct(F.col("below_epc_c")).alias("pct_below_epc_c"),
        )
    )
