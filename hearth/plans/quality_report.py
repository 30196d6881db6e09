"""Data-quality report over the silver and gold tables (Q1-Q7).

The rule set mirrors the reference's table tests (not_null, unique,
accepted_range) and its export invariants (low <= mid <= high, shares sum
to 100). Each table is checked in one aggregate pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import accepted_range, check_table, not_null, ordered, row_count, sums_to, unique
from ..session import durable
from ..sources import bronze
from . import gold, layers, reach, retrofit

def _key(c: str) -> list[tuple]:
    return [("not_null", c), ("unique", c)]


def _bounded(c: str, low=None, high=None, required: bool = False) -> list[tuple]:
    return [("not_null", c)] * required + [("accepted_range", c, low, high)]


RULES = {
    "certificates": [*_key("certificate_id"), ("not_null", "borough"), *_bounded("epc_score", 1, 100), *_bounded("floor_area_m2", 0)],
    "area_quality": [*_key("borough"), *_bounded("social_properties", 1, required=True),
                     *_bounded("pct_below_epc_c", 0, 100, required=True), *_bounded("avg_epc_score", 0, 100),
                     *_bounded("pct_pre_1950", 0, 100)],
    "area_deprivation": [*_key("la_name"), *_bounded("imd_score", 0, required=True),
                         *_bounded("income_deprivation_rate", 0, 1, required=True), *_bounded("lsoa_count", 1)],
    "area_priority": [("row_count", bronze.PRIORITY_AREAS), *_key("borough"),
                      *_bounded("priority_rank", 1, bronze.PRIORITY_AREAS, required=True),
                      *_bounded("priority_score", 1, required=True), *_bounded("pct_below_epc_c", 0, 100, required=True),
                      *_bounded("income_deprivation_rate", 0, 1, required=True), *_bounded("pct_pre_1950", 0, 100, required=True)],
    "retrofit_costs": [*_key("borough"), *_bounded("total_recommendations", 1, required=True),
                       *_bounded("avg_cost_per_recommendation", 0), *_bounded("total_indicative_cost_m", 0)],
    "retrofit_scenarios": [*_key("borough"), *_bounded("properties_with_recs", 1, required=True),
                           *_bounded("per_home_optimistic", 0), *_bounded("per_home_central", 0), *_bounded("per_home_pessimistic", 0),
                           ("ordered", "per_home_optimistic", "per_home_central", "per_home_pessimistic"),
                           ("ordered", "total_optimistic_m", "total_central_m", "total_pessimistic_m"),
                           *_bounded("uncertainty_pct", 0)],
    "wall_split": [*_key("borough"), *_bounded("pct_solid_wall", 0, 100, required=True), *_bounded("pct_cavity_wall", 0, 100),
                   ("sums_to", ["pct_solid_wall", "pct_cavity_wall"], 100)],
    "reachability_shares": [("unique", "borough"),
                            ("sums_to", ["pct_already_c", "pct_can_reach", "pct_cannot_reach"], 100)],
}


def _rule(spec):
    kind, *args = spec
    if kind == "not_null":
        return not_null(args[0])
    if kind == "unique":
        return unique(args[0])
    if kind == "accepted_range":
        return accepted_range(*args)
    if kind == "ordered":
        return ordered(*args)
    if kind == "row_count":
        return row_count(args[0])
    if kind == "sums_to":
        return sums_to(args[0], args[1])
    raise ValueError(kind)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The checked tables. Those read twice, a row per area each, are kept; the rest is read once."""
    silver, joined = retrofit.enriched(spark, sf_dir)
    quality = durable(gold.area_quality(silver))
    deprivation = durable(gold.area_deprivation(bronze.raw_deprivation(spark, sf_dir)))
    rolled = layers.retrofit_rollup(spark, sf_dir)
    return {
        "certificates": silver,
        "area_quality": quality,
        "area_deprivation": deprivation,
        "area_priority": gold.composite_priority_from(quality, deprivation),
        "retrofit_costs": retrofit.retrofit_costs(rolled),
        "retrofit_scenarios": retrofit.retrofit_scenarios(joined),
        "wall_split": retrofit.wall_split(rolled),
        "reachability_shares": reach.reachability_shares(silver),
    }


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tbl = tables(spark, sf_dir)
    parts = [check_table(tbl[name], name, [_rule(r) for r in rules]) for name, rules in RULES.items()]
    return reduce(DataFrame.unionByName, parts)
