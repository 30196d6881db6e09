"""Named queries over the driver's tables (see SURVEY §7.4 for the binding)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators.dedup import dedup_stats, property_key
from ..sources import bronze
from . import gold, layers, silver
from .catalog import register


@register("latest_record_per_key")
def latest_record_per_key(spark, sf_dir):
    return silver.certificates_silver(spark, sf_dir).select(
        "certificate_id", "uprn", "borough", "epc_rating", "epc_score", "inspection_date",
        "inspection_year", "below_epc_c", "fuel_category", "construction_age_band")


@register("dedup_stats")
def q_dedup_stats(spark, sf_dir):
    return dedup_stats(silver.project_certificates(bronze.raw_certificates(spark, sf_dir)), property_key())


@register("area_quality")
def q_area_quality(spark, sf_dir):
    return gold.area_quality(layers.homes(spark, sf_dir))


@register("area_deprivation")
def q_area_deprivation(spark, sf_dir):
    return gold.area_deprivation(bronze.raw_deprivation(spark, sf_dir))


@register("composite_priority")
def q_composite_priority(spark, sf_dir):
    return gold.composite_priority(spark, sf_dir)


@register("unmatched_keys")
def q_unmatched_keys(spark, sf_dir):
    return gold.unmatched_keys(spark, sf_dir)


@register("top_area_trend")
def q_top_area_trend(spark, sf_dir):
    return gold.top_area_trend(spark, sf_dir)


# ---------------------------------------------------------------- retrofit
from . import retrofit as R  # noqa: E402


def _with_areas(fn):
    def run(spark, sf_dir):
        return fn(layers.retrofit_base(spark, sf_dir), R.priority_areas(spark, sf_dir, layers.homes(spark, sf_dir)))
    return run


def _joined(fn):
    def run(spark, sf_dir):
        return fn(layers.retrofit_base(spark, sf_dir))
    return run


def _rolled(fn):
    def run(spark, sf_dir):
        return fn(layers.retrofit_rollup(spark, sf_dir))
    return run


def _rolled_with_areas(fn):
    def run(spark, sf_dir):
        areas = R.priority_areas(spark, sf_dir, layers.homes(spark, sf_dir))
        return fn(layers.retrofit_rollup(spark, sf_dir), areas)
    return run


register("retrofit_costs")(_rolled(R.retrofit_costs))
register("retrofit_scenarios")(_joined(R.retrofit_scenarios))
register("wall_split")(_rolled(R.wall_split))
register("common_types")(_rolled(R.common_types))
register("expensive_types")(_rolled(R.expensive_types))
register("cost_range_by_type")(_rolled(R.cost_range_by_type))
register("wall_share_by_area")(_rolled(R.wall_share_by_area))
register("priority_scenarios")(_with_areas(R.priority_scenarios))
register("category_costs")(_rolled(R.category_costs))
register("area_category_costs")(_rolled_with_areas(R.area_category_costs))
register("work_tiers")(_rolled(R.work_tiers))
register("tier_share_by_area")(_joined(R.tier_share_by_area))
register("quick_win_detail")(_rolled_with_areas(R.quick_win_detail))
register("first_ranked_types")(_rolled(R.first_ranked_types))
register("top3_first_ranked")(_rolled_with_areas(R.top3_first_ranked))
register("cost_by_position")(_rolled(R.cost_by_position))
register("avg_cost_priority")(_rolled_with_areas(R.avg_cost_priority))
register("top5_types_per_area")(_rolled_with_areas(R.top5_types_per_area))


# ---------------------------------------------------------------- lettings
from . import lettings as L  # noqa: E402

LETTINGS_OUT = ["year", "let_type", "tenancy_type", "household_size", "bedroom_standard", "bedrooms_vs_need",
                "previous_tenure", "reason_for_letting", "weekly_income_band", "weekly_rent_band",
                "rent_shortfall_band", "ethnicity", "tenancy_length_band", "employment_status", "region_code",
                "weekly_income_est", "weekly_rent_est", "rent_shortfall_est", "rent_to_income_pct", "overcrowded"]


@register("lettings_silver")
def q_lettings_silver(spark, sf_dir):
    return L.lettings_silver(spark, sf_dir).select(*LETTINGS_OUT)


@register("affordability_trend")
def q_affordability_trend(spark, sf_dir):
    return L.affordability_trend(layers.lettings(spark, sf_dir))


@register("lettings_sanity")
def q_lettings_sanity(spark, sf_dir):
    return L.lettings_sanity(layers.lettings(spark, sf_dir))


@register("rows_by_source")
def q_rows_by_source(spark, sf_dir):
    return L.rows_by_source(spark, sf_dir)


register("column_availability")(L.columns_by_source)
register("headers_by_file")(L.headers_by_file)
register("rows_in_scope_by_file")(L.rows_in_scope_by_file)


@register("band_midpoint_table")
def q_band_midpoint_table(spark, sf_dir):
    s = layers.lettings(spark, sf_dir)
    parts = [s.select(F.col(b).alias("band"), F.col(e).alias("midpoint"))
             for b, e in (("weekly_income_band", "weekly_income_est"), ("weekly_rent_band", "weekly_rent_est"),
                          ("rent_shortfall_band", "rent_shortfall_est"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


@register("cost_bounds_table")
def q_cost_bounds_table(spark, sf_dir):
    return (silver.recommendations(spark, sf_dir)
            .select("indicative_cost", "cost_low", "cost_mid", "cost_high").distinct())


# ---------------------------------------------------------------- profiling
from ..functions import columns as C  # noqa: E402
from ..operators import profile as P  # noqa: E402

CERT_AUDIT_COLUMNS = ["region", "postcode", "co2_emiss_curr_per_floor_area", "local_authority_label", "tenure", "property_type",
                      "construction_age_band", "current_energy_rating", "current_energy_efficiency",
                      "total_floor_area", "main_fuel", "inspection_date", "mains_gas_flag"]


@register("tenure_counts")
def q_tenure_counts(spark, sf_dir):
    return P.value_counts(bronze.raw_certificates(spark, sf_dir), "tenure")


@register("silver_value_counts")
def q_silver_value_counts(spark, sf_dir):
    return P.multi_value_counts(layers.certificates(spark, sf_dir),
                                ["property_type", "built_form", "construction_age_band", "fuel_category",
                                 "epc_rating"])


@register("raw_cost_counts")
def q_raw_cost_counts(spark, sf_dir):
    return P.value_counts(layers.retrofit_base(spark, sf_dir), "indicative_cost", 20)


@register("rating_distribution")
def q_rating_distribution(spark, sf_dir):
    vc = (silver.in_scope_certificates(bronze.raw_certificates(spark, sf_dir)).groupBy("epc_rating")
          .agg(F.count(F.lit(1)).alias("count")))
    every = Window.partitionBy(F.lit(0))   # one row per rating
    below = F.sum(F.when(F.col("below_c"), F.col("count")).otherwise(0)).over(every)
    return (P.share_of_total(vc).withColumn("below_c", C.below_c_flag("epc_rating"))
            .withColumn("total", F.sum("count").over(every))
            .withColumn("pct_below_c_overall", F.round(below / F.col("total") * 100, 1)))


@register("score_stats")
def q_score_stats(spark, sf_dir):
    return silver.in_scope_certificates(bronze.raw_certificates(spark, sf_dir)).agg(
        F.round(F.avg("epc_score"), 1).alias("mean_score"),
        F.min("epc_score").alias("min_score"), F.max("epc_score").alias("max_score"))


@register("area_breakdown")
def q_area_breakdown(spark, sf_dir):
    proj = silver.in_scope_certificates(bronze.raw_certificates(spark, sf_dir))
    return (proj.filter(F.col("borough").isNotNull()).groupBy("borough").agg(
        F.count(F.lit(1)).alias("properties"),
        F.round(F.avg("epc_score"), 1).alias("avg_epc_score"),
        F.sum(F.when(C.below_c_flag("epc_rating"), 1).otherwise(0)).alias("below_c_count"))
        .withColumn("pct_below_c", F.round(F.col("below_c_count") / F.col("properties") * 100, 1)))


@register("year_histogram")
def q_year_histogram(spark, sf_dir):
    return (silver.in_scope_certificates(bronze.raw_certificates(spark, sf_dir))
            .groupBy(F.year("inspection_date").alias("inspection_year")).agg(F.count(F.lit(1)).alias("count")))


@register("null_audit")
def q_null_audit(spark, sf_dir):
    return P.null_audit(layers.certificates(spark, sf_dir))


@register("blank_audit")
def q_blank_audit(spark, sf_dir):
    raw = bronze.raw_certificates(spark, sf_dir)
    scope = C.tenure_in_scope(F.trim("tenure")) & (F.trim("region") == fixed.TARGET_REGION)
    return P.blank_audit(raw.filter(scope), CERT_AUDIT_COLUMNS)


@register("lettings_blank_audit")
def q_lettings_blank_audit(spark, sf_dir):
    raw = bronze.raw_lettings(spark, sf_dir)
    london = raw.filter(F.trim("GOVREG").isin(*fixed.LETTINGS_REGION_CODES))
    return P.blank_audit(london, ["HHMEMBT", "BEDST", "BED_MINUS_BEDSTANDARD", "YEAR"])


@register("coverage")
def q_coverage(spark, sf_dir):
    # Membership flag (J8): left join to the distinct recommendation keys.
    s = layers.certificates(spark, sf_dir).select("certificate_id")
    keys = (silver.recommendations(spark, sf_dir).select("certificate_id").distinct()
            .withColumn("has_recs", F.lit(True)))
    flagged = s.join(keys, "certificate_id", "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("total_certs"),
        F.count_if(F.col("has_recs").isNotNull()).alias("certs_with_recs"),
        F.round(F.try_divide(F.count_if(F.col("has_recs").isNotNull()), F.count(F.lit(1))) * 100, 1)
        .alias("pct_with_recs"))


@register("carbon_rank")
def q_carbon_rank(spark, sf_dir):
    from ..operators.ranking import rank_desc
    pr = gold.composite_priority(spark, sf_dir).select("priority_rank", "borough", "avg_co2_per_m2",
                                                       "pct_below_epc_c")
    return rank_desc(pr, "avg_co2_per_m2", "carbon_rank")


@register("carbon_summary")
def q_carbon_summary(spark, sf_dir):
    pr = gold.composite_priority(spark, sf_dir)
    return pr.agg(F.round(F.avg("avg_co2_per_m2"), 2).alias("area_avg"),
                  F.min("avg_co2_per_m2").alias("area_min"), F.max("avg_co2_per_m2").alias("area_max"))


@register("scope_share")
def q_scope_share(spark, sf_dir):
    raw = bronze.raw_certificates(spark, sf_dir)
    scope = C.tenure_in_scope(F.trim("tenure")) & (F.trim("region") == fixed.TARGET_REGION)
    rows = raw.agg(
        F.count(F.lit(1)).alias("all_rows"),
        F.count_if(scope).alias("in_scope_rows"),
        F.round(F.try_divide(F.count_if(scope), F.count(F.lit(1))) * 100, 1).alias("pct_in_scope"))
    values = P.distinct_counts(raw.where(scope), {"distinct_uprn": F.trim("uprn"), "areas": F.trim("local_authority_label"),
                                                  "property_types": F.trim("property_type")})
    both = rows.unionByName(values, allowMissingColumns=True)   # one row each
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


# ---------------------------------------------------------------- reachability and greedy cover
from . import reach as RC  # noqa: E402


def _scored_silver(fn):
    def run(spark, sf_dir):
        return fn(layers.homes(spark, sf_dir))
    return run


register("funnel")(_scored_silver(RC.funnel))
register("gap_percentiles")(_scored_silver(RC.gap_percentiles))
register("age_distribution")(_scored_silver(RC.age_distribution))
register("reachability_shares")(_scored_silver(RC.reachability_shares))


@register("frequent_types")
def q_frequent_types(spark, sf_dir):
    return RC.frequent_types(RC.scored_recs(spark, sf_dir))


@register("type_property_counts")
def q_type_property_counts(spark, sf_dir):
    return RC.type_property_counts(RC.scored_recs(spark, sf_dir))


@register("attribution_by_age")
def q_attribution_by_age(spark, sf_dir):
    s = layers.homes(spark, sf_dir)
    recs = RC.scored_recs(spark, sf_dir)
    return RC.attribution_table(RC.uplift_attribution(recs, s), recs)


@register("cost_efficiency")
def q_cost_efficiency(spark, sf_dir):
    s = layers.homes(spark, sf_dir)
    recs = RC.scored_recs(spark, sf_dir)
    return RC.cost_efficiency(RC.attribution_table(RC.uplift_attribution(recs, s), recs), recs)


@register("greedy_cover")
def q_greedy_cover(spark, sf_dir):
    return RC.greedy_tables(spark, sf_dir, with_props=False)[-1]


@register("greedy_headline")
def q_greedy_headline(spark, sf_dir):
    return RC.greedy_headline(RC.greedy_tables(spark, sf_dir, with_props=False)[-1])


@register("property_class_counts")
def q_property_class_counts(spark, sf_dir):
    props = RC.greedy_tables(spark, sf_dir)[-1]
    return props.groupBy(F.col("category").alias("value")).agg(F.count(F.lit(1)).alias("count"))


@register("area_greedy_summary")
def q_area_greedy_summary(spark, sf_dir):
    s, *_, props = RC.greedy_tables(spark, sf_dir)
    return RC.area_greedy_summary(s, props)


@register("age_cost_stats")
def q_age_cost_stats(spark, sf_dir):
    return RC.age_cost_stats(RC.greedy_tables(spark, sf_dir)[-1])


# ---------------------------------------------------------------- data quality (Q1-Q7)
from .quality_report import quality_report  # noqa: E402

register("quality_report")(quality_report)


# ---------------------------------------------------------------- statistics and models
from . import analytics as AN  # noqa: E402

for _name in ("corr_matrix", "regression_line", "standardised", "pca_rank", "pca_components", "kmeans_sweep",
              "kmeans_tiers", "cluster_profile", "bisecting_tiers", "ward_linkage", "ward_tiers", "method_agreement", "uplift_model_metrics",
              "path_attribution", "attribution_check", "attribution_by_age_model", "greedy_model_summary"):
    register(_name)(getattr(AN, _name))


from . import model_checks as MC  # noqa: E402

for _name in ("component_check", "tier_check", "sweep_check", "ward_check", "ordinal_codes", "split_check", "forest_check",
              "metrics_check", "model_tables_check", "agreement_check", "hot_fill_check"):
    register(_name)(getattr(MC, _name))


@register("multi_hot")
def q_multi_hot(spark, sf_dir):
    recs = layers.retrofit_base(spark, sf_dir)
    types = AN.frequent_type_names(recs)
    if not types:
        return recs.select("certificate_id", "improvement_type").limit(0)
    wide = AN.multi_hot(recs, types)
    hot = F.array(*[F.struct(F.lit(t).alias("improvement_type"), F.col(AN.type_column(i)).alias("present"))
                    for i, t in enumerate(types)])
    return wide.select("certificate_id", F.explode(hot).alias("e")).where("e.present = 1").select(
        "certificate_id", "e.improvement_type")


# ---------------------------------------------------------------- raw-file ingest and exports
from . import ingest as IG  # noqa: E402


@register("certificates_from_csv")
def q_certificates_from_csv(spark, sf_dir):
    return IG.certificates_from_csv(spark, sf_dir).select(
        "certificate_id", "uprn", "borough", "epc_rating", "epc_score", "inspection_date",
        "inspection_year", "below_epc_c", "fuel_category", "construction_age_band")


@register("recommendations_from_csv")
def q_recommendations_from_csv(spark, sf_dir):
    return IG.recommendations_from_csv(spark, sf_dir)


register("deprivation_from_csv")(IG.deprivation_from_csv)
register("export_roundtrip")(IG.export_roundtrip)
register("retrofit_costs_sql")(IG.retrofit_costs_sql)

from . import marts as MT  # noqa: E402

register("retrofit_costs_from_views")(MT.retrofit_costs_from_views)
register("retrofit_costs_catalog")(MT.retrofit_costs_catalog)


# ---------------------------------------------------------------- region lookup, semi-join scope, recent periods
@register("region_counts")
def q_region_counts(spark, sf_dir):
    """Rows by region with region names (A21, C12), top 10."""
    vc = P.value_counts(bronze.raw_certificates(spark, sf_dir), "region", 10)
    return vc.withColumn("region_name", C.region_name("value"))


@register("scoped_recommendations")
def q_scoped_recommendations(spark, sf_dir):
    """Recommendations of in-scope certificates only, as a left-semi join."""
    certs = layers.certificates(spark, sf_dir).select("certificate_id")
    return (silver.recommendations(spark, sf_dir).join(certs, "certificate_id", "left_semi")
            .select("certificate_id", "priority", "improvement_type", "indicative_cost"))


@register("recent_affordability")
def q_recent_affordability(spark, sf_dir):
    """The most recent three years of the affordability trend (O3)."""
    return L.affordability_trend(layers.lettings(spark, sf_dir)).orderBy(F.desc("year")).limit(3)
