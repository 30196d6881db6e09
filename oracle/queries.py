"""Oracle SQL per registered query (DuckDB dialect)."""

from __future__ import annotations

from hearth.functions import fixed

from .views import inlist, q, sql

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLE[name] = sql(body)


PCT = "round(sum(CASE WHEN {c} THEN 1 ELSE 0 END) / count(*) * 100, 1)"

oracle("latest_record_per_key", """
SELECT certificate_id, uprn, borough, epc_rating, epc_score, inspection_date, inspection_year,
       below_epc_c, fuel_category, construction_age_band
FROM cert_silver""")

oracle("dedup_stats", """
SELECT count(*) AS rows_before, count(DISTINCT dedup_key) AS rows_after,
       count(*) - count(DISTINCT dedup_key) AS rows_removed,
       round((count(*) - count(DISTINCT dedup_key)) / count(*) * 100, 1) AS pct_removed
FROM cert_keyed""")

AREA_QUALITY = f"""
, area_quality AS (
  SELECT borough, count(*) AS social_properties,
         round(avg(epc_score), 1) AS avg_epc_score,
         {PCT.format(c='below_epc_c')} AS pct_below_epc_c,
         {PCT.format(c='construction_age_band IN ' + inlist(fixed.PRE_1950_BANDS))} AS pct_pre_1950,
         round(avg(co2_emissions), 2) AS avg_co2_per_m2
  FROM cert_silver GROUP BY borough
)"""

AREA_DEPRIVATION = """
, area_deprivation AS (
  SELECT "Local Authority District name (2019)" AS la_name,
         round(avg("Index of Multiple Deprivation (IMD) Score"), 3) AS imd_score,
         round(avg("Income Score (rate)"), 4) AS income_deprivation_rate,
         round(avg("Employment Score (rate)"), 4) AS employment_deprivation_rate,
         round(avg("Health Deprivation and Disability Score"), 3) AS health_deprivation_score,
         round(avg("Living Environment Score"), 3) AS living_env_score,
         count(*) AS lsoa_count
  FROM raw_imd WHERE "Local Authority District code (2019)" LIKE 'E09%'
  GROUP BY 1
)"""

PRIORITY = AREA_QUALITY + AREA_DEPRIVATION + """
, pj AS (
  SELECT q.*, d.income_deprivation_rate, d.imd_score, d.employment_deprivation_rate, d.health_deprivation_score, d.living_env_score
  FROM area_quality q JOIN area_deprivation d ON upper(trim(q.borough)) = upper(trim(d.la_name))
), pr AS (
  SELECT *, dense_rank() OVER (ORDER BY pct_below_epc_c DESC NULLS LAST) AS rank_epc,
            dense_rank() OVER (ORDER BY income_deprivation_rate DESC NULLS LAST) AS rank_income,
            dense_rank() OVER (ORDER BY pct_pre_1950 DESC NULLS LAST) AS rank_age
  FROM pj
), ps AS (
  SELECT *, round((rank_epc + rank_income + rank_age) / CAST(3 AS DOUBLE), 1) AS priority_score FROM pr
), priority AS (
  SELECT CAST(dense_rank() OVER (ORDER BY priority_score ASC NULLS LAST) AS INTEGER) AS priority_rank,
         borough, priority_score, pct_below_epc_c, income_deprivation_rate, pct_pre_1950, avg_epc_score,
         imd_score, employment_deprivation_rate, health_deprivation_score, living_env_score, avg_co2_per_m2, social_properties,
         CAST(rank_epc AS INTEGER) AS rank_epc, CAST(rank_income AS INTEGER) AS rank_income,
         CAST(rank_age AS INTEGER) AS rank_age
  FROM ps
)"""

oracle("area_quality", AREA_QUALITY + "\nSELECT * FROM area_quality")
oracle("area_deprivation", AREA_DEPRIVATION + "\nSELECT * FROM area_deprivation")
oracle("composite_priority", PRIORITY + "\nSELECT * FROM priority")
oracle("unmatched_keys", AREA_QUALITY + AREA_DEPRIVATION + """
SELECT borough, social_properties FROM area_quality q
WHERE NOT EXISTS (SELECT 1 FROM area_deprivation d WHERE upper(trim(d.la_name)) = upper(trim(q.borough)))""")
oracle("top_area_trend", PRIORITY + f"""
, top_n AS (SELECT borough FROM priority ORDER BY priority_rank, borough LIMIT {fixed.TOP_AREAS})
SELECT borough, inspection_year, count(*) AS inspections, round(avg(epc_score), 1) AS avg_epc_score,
       {PCT.format(c='below_epc_c')} AS pct_below_epc_c
FROM cert_silver
WHERE inspection_year BETWEEN {fixed.TREND_YEARS[0]} AND {fixed.TREND_YEARS[1]}
  AND borough IN (SELECT borough FROM top_n)
GROUP BY borough, inspection_year""")


# ---------------------------------------------------------------- retrofit
from .views import categorise_sql  # noqa: E402

ENRICHED = f"""
, jx AS (
  SELECT *, {categorise_sql('improvement_type')} AS category,
         CASE WHEN cost_mid <= {fixed.QUICK_WIN_MAX} THEN {q(fixed.QUICK_WIN)} ELSE {q(fixed.MAJOR_WORKS)} END AS work_tier
  FROM joined
)"""
AREAS = PRIORITY + f"""
, areas AS (SELECT borough FROM priority ORDER BY priority_rank, borough LIMIT {fixed.TOP_AREAS})
, jp AS (SELECT * FROM jx WHERE borough IN (SELECT borough FROM areas))"""


def retro(name: str, body: str, areas: bool = False) -> None:
    oracle(name, ENRICHED + (AREAS if areas else "") + "\n" + body)


retro("retrofit_costs", """
SELECT borough, count(certificate_id) AS total_recommendations,
       round(avg(cost_mid), 0) AS avg_cost_per_recommendation,
       round(sum(cost_mid) / 1e6, 2) AS total_indicative_cost_m
FROM jx GROUP BY borough""")

retro("retrofit_scenarios", """
SELECT borough, count(certificate_id) AS total_recommendations,
       count(DISTINCT certificate_id) AS properties_with_recs,
       round(sum(cost_low) / 1e6, 2) AS total_optimistic_m,
       round(sum(cost_mid) / 1e6, 2) AS total_central_m,
       round(sum(cost_high) / 1e6, 2) AS total_pessimistic_m,
       round(sum(cost_low) / count(DISTINCT certificate_id), 0) AS per_home_optimistic,
       round(sum(cost_mid) / count(DISTINCT certificate_id), 0) AS per_home_central,
       round(sum(cost_high) / count(DISTINCT certificate_id), 0) AS per_home_pessimistic,
       round((sum(cost_high) - sum(cost_low)) / nullif(sum(cost_mid), 0) * 100, 1) AS uncertainty_pct
FROM jx GROUP BY borough""")

retro("wall_split", f"""
, agg AS (
  SELECT borough, count(certificate_id) AS total_recs,
         CAST(sum(CASE WHEN improvement_id = {fixed.CAVITY_WALL_ID} THEN 1 ELSE 0 END) AS BIGINT) AS cavity_wall_recs,
         CAST(sum(CASE WHEN improvement_id = {fixed.SOLID_WALL_ID} THEN 1 ELSE 0 END) AS BIGINT) AS solid_wall_recs
  FROM jx GROUP BY borough)
SELECT *, cavity_wall_recs + solid_wall_recs AS total_wall_recs,
       round(solid_wall_recs / nullif(cavity_wall_recs + solid_wall_recs, 0) * 100, 1) AS pct_solid_wall,
       round(cavity_wall_recs / nullif(cavity_wall_recs + solid_wall_recs, 0) * 100, 1) AS pct_cavity_wall
FROM agg WHERE cavity_wall_recs + solid_wall_recs > 0""")

retro("common_types", """
SELECT improvement_type, count(*) AS times_recommended, round(avg(cost_mid), 0) AS avg_cost
FROM jx GROUP BY improvement_type ORDER BY times_recommended DESC, improvement_type ASC NULLS LAST LIMIT 20""")

retro("expensive_types", """
SELECT * FROM (SELECT improvement_type, count(*) AS times_recommended, round(avg(cost_mid), 0) AS avg_cost
               FROM jx GROUP BY improvement_type) WHERE times_recommended > 100
ORDER BY avg_cost DESC, improvement_type ASC NULLS LAST LIMIT 15""")

retro("cost_range_by_type", """
SELECT * FROM (SELECT improvement_type, count(*) AS times_recommended, round(avg(cost_low), 0) AS avg_low,
                      round(avg(cost_mid), 0) AS avg_mid, round(avg(cost_high), 0) AS avg_high
               FROM jx GROUP BY improvement_type) WHERE times_recommended > 100
ORDER BY avg_mid DESC, improvement_type ASC NULLS LAST LIMIT 20""")

retro("wall_share_by_area", """
SELECT borough, count(certificate_id) AS total_recs,
       CAST(sum(CASE WHEN regexp_matches(improvement_type, 'wall insulation', 'i') THEN 1 ELSE 0 END) AS BIGINT) AS wall_insulation_recs,
       round(sum(CASE WHEN regexp_matches(improvement_type, 'wall insulation', 'i') THEN 1 ELSE 0 END)
             / count(certificate_id) * 100, 1) AS pct_needing_wall_insulation
FROM jx GROUP BY borough""")

retro("priority_scenarios", """
SELECT borough, count(DISTINCT certificate_id) AS properties,
       round(sum(cost_low) / count(DISTINCT certificate_id), 0) AS per_home_low,
       round(sum(cost_mid) / count(DISTINCT certificate_id), 0) AS per_home_mid,
       round(sum(cost_high) / count(DISTINCT certificate_id), 0) AS per_home_high,
       round(sum(cost_low) / 1e6, 2) AS total_low_m,
       round(sum(cost_mid) / 1e6, 2) AS total_mid_m,
       round(sum(cost_high) / 1e6, 2) AS total_high_m
FROM jp GROUP BY borough""", areas=True)

retro("category_costs", """
SELECT category, count(*) AS recommendations, round(avg(cost_mid), 0) AS avg_cost_per_rec,
       round(sum(cost_mid) / 1e6, 1) AS total_cost_m, round(sum(cost_low) / 1e6, 1) AS total_low_m,
       round(sum(cost_high) / 1e6, 1) AS total_high_m
FROM jx GROUP BY category""")

retro("area_category_costs", """
SELECT borough, category, count(*) AS recs, round(sum(cost_mid) / 1e6, 2) AS cost_m
FROM jp GROUP BY borough, category""", areas=True)

retro("work_tiers", """
SELECT work_tier, count(*) AS recommendations, round(avg(cost_mid), 0) AS avg_cost,
       round(sum(cost_mid) / 1e6, 1) AS total_cost_m
FROM jx GROUP BY work_tier""")

retro("tier_share_by_area", f"""
SELECT borough, count(*) AS total_recs,
       round(sum(CASE WHEN work_tier = {q(fixed.QUICK_WIN)} THEN 1 ELSE 0 END) / count(*) * 100, 1) AS pct_quick_wins,
       round(sum(CASE WHEN work_tier = {q(fixed.MAJOR_WORKS)} THEN 1 ELSE 0 END) / count(*) * 100, 1) AS pct_major_works,
       round(sum(cost_mid) / count(DISTINCT certificate_id), 0) AS cost_per_home
FROM jx GROUP BY borough""")

retro("quick_win_detail", f"""
SELECT borough, work_tier, improvement_type, count(*) AS recs, round(avg(cost_mid), 0) AS avg_cost
FROM jp WHERE work_tier = {q(fixed.QUICK_WIN)} GROUP BY borough, work_tier, improvement_type""", areas=True)

retro("first_ranked_types", """
SELECT improvement_type, category, count(*) AS times_top_priority, round(avg(cost_mid), 0) AS avg_cost
FROM jx WHERE priority = 1 GROUP BY improvement_type, category
ORDER BY times_top_priority DESC, improvement_type ASC NULLS LAST LIMIT 15""")

retro("top3_first_ranked", """
SELECT * FROM (
  SELECT borough, improvement_type, category, count(*) AS times_top,
         CAST(rank() OVER (PARTITION BY borough ORDER BY count(*) DESC) AS INTEGER) AS rnk
  FROM jp WHERE priority = 1 GROUP BY borough, improvement_type, category)
WHERE rnk <= 3""", areas=True)

retro("cost_by_position", """
SELECT priority, count(*) AS recommendations, round(avg(cost_mid), 0) AS avg_cost
FROM jx GROUP BY priority HAVING priority <= 10""")

retro("avg_cost_priority", """
SELECT borough, round(avg(cost_mid), 0) AS avg_cost_per_rec FROM jp GROUP BY borough""", areas=True)

retro("top5_types_per_area", """
SELECT * FROM (
  SELECT borough, improvement_type, count(*) AS times_recommended, round(avg(cost_mid), 0) AS avg_cost,
         CAST(rank() OVER (PARTITION BY borough ORDER BY count(*) DESC) AS INTEGER) AS rnk
  FROM jp GROUP BY borough, improvement_type)
WHERE rnk <= 5""", areas=True)


# ---------------------------------------------------------------- lettings
from hearth.sources import bronze as _B  # noqa: E402

oracle("lettings_silver", """
SELECT year, let_type, tenancy_type, household_size, bedroom_standard, bedrooms_vs_need, previous_tenure,
       reason_for_letting, weekly_income_band, weekly_rent_band, rent_shortfall_band, ethnicity,
       tenancy_length_band, employment_status, region_code, weekly_income_est, weekly_rent_est,
       rent_shortfall_est, rent_to_income_pct, overcrowded
FROM lettings_silver""")

oracle("affordability_trend", """
SELECT year, count(*) AS lettings, round(avg(weekly_rent_est), 2) AS avg_weekly_rent,
       round(avg(weekly_income_est), 2) AS avg_weekly_income,
       round(avg(rent_to_income_pct), 1) AS avg_rent_to_income_pct,
       round(sum(CASE WHEN rent_to_income_pct > 50 THEN 1 ELSE 0 END) / count(*) * 100, 1) AS pct_spending_over_50pct_on_rent,
       round(sum(CASE WHEN overcrowded THEN 1 ELSE 0 END) / count(*) * 100, 1) AS pct_overcrowded
FROM lettings_silver WHERE weekly_rent_est IS NOT NULL AND weekly_income_est IS NOT NULL
GROUP BY year""")

oracle("lettings_sanity", """
SELECT count(*) AS lettings, count(weekly_rent_est) AS with_rent,
       round(avg(weekly_rent_est), 2) AS avg_weekly_rent, round(avg(weekly_income_est), 2) AS avg_weekly_income,
       round(avg(rent_to_income_pct), 1) AS avg_rent_to_income_pct
FROM lettings_silver""")

oracle("rows_by_source", """
SELECT variant AS source, count(*) AS rows_in_scope FROM let_std GROUP BY variant
UNION ALL SELECT 'total', count(*) FROM let_std""")

_pairs = ", ".join(f"({q(v)}, {q(c)})" for v, cols in _B.LETTINGS_VARIANTS.items() for c in cols)
_variants = sorted(_B.LETTINGS_VARIANTS)
oracle("column_availability", f"""
, hdr(source, column_name) AS (VALUES {_pairs})
, present AS (SELECT h.* FROM hdr h WHERE h.source IN (SELECT DISTINCT event_type FROM events))
SELECT column_name, {", ".join(f"CAST(count(*) FILTER (WHERE source = {q(v)}) AS BIGINT) AS {v}" for v in _variants)}
FROM present GROUP BY column_name""")

oracle("rows_in_scope_by_file", """
, shipped AS (SELECT DISTINCT variant || '/' || YEAR AS file FROM raw_lettings)
, scoped AS (SELECT variant || '/' || year AS file, count(*) AS n FROM let_std GROUP BY 1)
SELECT s.file, CAST(coalesce(n, 0) AS BIGINT) AS rows_in_scope FROM shipped s LEFT JOIN scoped c ON s.file = c.file
UNION ALL SELECT 'total', count(*) FROM let_std""")

# the header of each layout, written out
_main = ["GOVREG", "YEAR", "LETTYPE", "TENANCY", "HHMEMBT", "BEDST", "BED_MINUS_BEDSTANDARD", "PREVTEN_R", "REASON_R", "WEEKINC_T_Bands",
         "WRENT_Bands", "WTSHORTFALLHB_Bands", "ETHNIC_Bands", "TENANCYLENGTH_Bands", "econstat_imputed_R"]
_headers = {
    "purchase": _main, "error": _main,
    "view": ["GOVREG", "YEAR", "LETTYPE", "TENANCY", "HHMEMBT", "BEDST", "BED_MINUS_BEDSTANDARD2", "PREVTEN_R", "REASON_R", "WEEKINC_T_Bands",
             "WRENT_Bands", "WTSHORTFALL_Bands", "ETHNIC_Bands", "TENANCYLENGTH_Bands", "econstat_imputed_R"],
    "click": ["GOVREG", "YEAR", "LETTYPE", "TENANCY", "HHMEMBT", "BEDST", "PREVTEN_R", "REASON_R", "WEEKINC_T_Bands", "WRENT_Bands",
              "WTSHORTFALLHB_Bands", "ETHNIC_Bands"],
    "signup": ["SEX1", "YEAR", "AGE1", "econstat_imputed_R", "TENANCYLENGTH_Bands", "ETHNIC_Bands", "WTSHORTFALLHB_Bands", "WRENT_Bands",
               "WEEKINC_T_Bands", "REASON_R", "PREVTEN_R", "BED_MINUS_BEDSTANDARD", "BEDST", "HHMEMBT", "TENANCY", "LETTYPE", "GOVREG"]}
oracle("headers_by_file", f"""
, hdr(variant, position, column_name) AS (VALUES {", ".join(f"({q(v)}, {i}, {q(c)})" for v, cols in _headers.items() for i, c in enumerate(cols))})
SELECT r.variant || '/' || r.YEAR AS file, CAST(h.position AS INTEGER) AS position, h.column_name
FROM (SELECT DISTINCT variant, YEAR FROM raw_lettings) r JOIN hdr h ON r.variant = h.variant""")

oracle("band_midpoint_table", """
SELECT DISTINCT band, midpoint FROM (
  SELECT weekly_income_band AS band, weekly_income_est AS midpoint FROM lettings_silver
  UNION ALL SELECT weekly_rent_band, weekly_rent_est FROM lettings_silver
  UNION ALL SELECT rent_shortfall_band, rent_shortfall_est FROM lettings_silver)""")

oracle("cost_bounds_table", """
SELECT DISTINCT indicative_cost, cost_low, cost_mid, cost_high FROM recs""")


# ---------------------------------------------------------------- profiling
oracle("tenure_counts", "SELECT tenure AS value, count(*) AS count FROM raw_cert GROUP BY tenure")

oracle("silver_value_counts", """
SELECT column_name, value, count(*) AS count FROM (
  SELECT 'property_type' AS column_name, property_type AS value FROM cert_silver
  UNION ALL SELECT 'built_form', built_form FROM cert_silver
  UNION ALL SELECT 'construction_age_band', construction_age_band FROM cert_silver
  UNION ALL SELECT 'fuel_category', fuel_category FROM cert_silver
  UNION ALL SELECT 'epc_rating', epc_rating FROM cert_silver)
GROUP BY column_name, value""")

oracle("raw_cost_counts", """
SELECT indicative_cost AS value, count(*) AS count FROM joined
GROUP BY indicative_cost ORDER BY count DESC, value ASC NULLS LAST LIMIT 20""")

oracle("rating_distribution", """
SELECT epc_rating, count(*) AS count, round(count(*) / sum(count(*)) OVER () * 100, 1) AS pct_of_total,
       CASE WHEN epc_rating IN ('D', 'E', 'F', 'G') THEN TRUE ELSE FALSE END AS below_c,
       (SELECT count(*) FROM cert_scope) AS total,
       (SELECT round(count(*) FILTER (WHERE epc_rating IN ('D', 'E', 'F', 'G')) / count(*) * 100, 1) FROM cert_scope) AS pct_below_c_overall
FROM cert_scope GROUP BY epc_rating""")

oracle("score_stats", """
SELECT round(avg(epc_score), 1) AS mean_score, min(epc_score) AS min_score, max(epc_score) AS max_score
FROM cert_scope""")

oracle("area_breakdown", f"""
SELECT borough, count(*) AS properties, round(avg(epc_score), 1) AS avg_epc_score,
       CAST(sum(CASE WHEN epc_rating IN {inlist(fixed.BELOW_C_RATINGS)} THEN 1 ELSE 0 END) AS BIGINT) AS below_c_count,
       round(sum(CASE WHEN epc_rating IN {inlist(fixed.BELOW_C_RATINGS)} THEN 1 ELSE 0 END) / count(*) * 100, 1) AS pct_below_c
FROM cert_scope WHERE borough IS NOT NULL GROUP BY borough""")

oracle("year_histogram", "SELECT CAST(year(inspection_date) AS INTEGER) AS inspection_year, count(*) AS count FROM cert_scope GROUP BY 1")

_SILVER_COLS = ["certificate_id", "uprn", "postcode", "address1", "local_authority_code", "borough", "tenure",
                "property_type", "built_form", "construction_age_band", "epc_rating", "epc_score",
                "floor_area_m2", "co2_emissions", "energy_consumption", "heating_cost", "epc_potential",
                "main_fuel", "walls_energy_eff", "roof_energy_eff", "windows_energy_eff", "mains_gas_flag",
                "inspection_date", "region_code", "below_epc_c", "inspection_year", "fuel_category"]
_FLOATS = {"epc_score", "floor_area_m2", "co2_emissions", "energy_consumption", "heating_cost", "epc_potential"}
oracle("null_audit", " UNION ALL ".join(
    f"SELECT {q(c)} AS column_name, count(*) FILTER (WHERE {c} IS NULL"
    + (f" OR isnan({c})" if c in _FLOATS else "") + ") AS nulls FROM cert_silver" for c in _SILVER_COLS))

_AUDIT = ["region", "postcode", "local_authority_label", "tenure", "property_type",
          "construction_age_band", "current_energy_rating", "current_energy_efficiency", "total_floor_area",
          "main_fuel", "inspection_date", "mains_gas_flag"]
oracle("blank_audit", " UNION ALL ".join(
    f"SELECT {q(c)} AS column_name, count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS blanks, "
    f"round(count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') / count(*) * 100, 1) AS pct_blank FROM raw_cert "
    f"WHERE upper(trim(tenure)) IN {inlist(fixed.SOCIAL_TENURES)} AND trim(region) = '{fixed.TARGET_REGION}'"
    for c in _AUDIT)
    + " UNION ALL SELECT 'co2_emiss_curr_per_floor_area', CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE)")   # not in the raw files

oracle("lettings_blank_audit", " UNION ALL ".join(
    f"SELECT {q(c)} AS column_name, count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS blanks, "
    f"round(count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') / count(*) * 100, 1) AS pct_blank "
    f"FROM raw_lettings WHERE trim(GOVREG) IN {inlist(fixed.LETTINGS_REGION_CODES)}"
    for c in ["HHMEMBT", "BEDST", "BED_MINUS_BEDSTANDARD", "YEAR"]))

oracle("coverage", """
SELECT count(*) AS total_certs,
       count(*) FILTER (WHERE certificate_id IN (SELECT certificate_id FROM recs)) AS certs_with_recs,
       round(count(*) FILTER (WHERE certificate_id IN (SELECT certificate_id FROM recs)) / count(*) * 100, 1) AS pct_with_recs
FROM cert_silver""")

oracle("carbon_rank", PRIORITY + """
SELECT priority_rank, borough, avg_co2_per_m2, pct_below_epc_c,
       CAST(rank() OVER (ORDER BY avg_co2_per_m2 DESC NULLS LAST) AS INTEGER) AS carbon_rank
FROM priority""")

oracle("carbon_summary", PRIORITY + """
SELECT round(avg(avg_co2_per_m2), 2) AS area_avg, min(avg_co2_per_m2) AS area_min, max(avg_co2_per_m2) AS area_max
FROM priority""")

oracle("scope_share", f"""
, sc AS (SELECT *, upper(trim(tenure)) IN {inlist(fixed.SOCIAL_TENURES)} AND trim(region) = '{fixed.TARGET_REGION}' AS scope
         FROM raw_cert)
SELECT count(*) AS all_rows, count(*) FILTER (WHERE scope) AS in_scope_rows,
       round(count(*) FILTER (WHERE scope) / count(*) * 100, 1) AS pct_in_scope,
       count(DISTINCT CASE WHEN scope THEN trim(uprn) END) AS distinct_uprn,
       count(DISTINCT CASE WHEN scope THEN trim(local_authority_label) END) AS areas,
       count(DISTINCT CASE WHEN scope THEN trim(property_type) END) AS property_types
FROM sc""")


# ---------------------------------------------------------------- reachability and greedy cover
from hearth.plans.reach import age_column  # noqa: E402

from .views import age_group_sql  # noqa: E402

_T, _CAP = fixed.TARGET_SCORE, fixed.EXEMPT_CAP
_ORDER = "CASE age_group " + " ".join(f"WHEN {q(g)} THEN {i}" for i, g in enumerate(fixed.AGE_ORDER)) \
    + f" ELSE {len(fixed.AGE_ORDER)} END"


def _money(x: str) -> str:
    return f"('£' || format('{{:,}}', CAST(round({x}) AS BIGINT)))"


def money_range_sql(m: str, lo: str, hi: str) -> str:
    return (f"CASE WHEN {m} IS NULL OR {lo} IS NULL OR {hi} IS NULL OR isnan({m}) OR isnan({lo}) OR isnan({hi}) "
            f"THEN '' ELSE {_money(m)} || ' (' || {_money(lo)} || '–' || {_money(hi)} || ')' END")


SCORED = f"""
, scored AS (
  SELECT *, {age_group_sql('construction_age_band')} AS age_group, epc_score < {_T} AS below_target,
         CASE WHEN epc_score < {_T} THEN {_T} - epc_score END AS gap,
         (epc_potential IS NOT NULL AND epc_potential >= {_T}) AS epc_reachable
  FROM cert_silver WHERE epc_score IS NOT NULL)
, below AS (SELECT * FROM scored WHERE below_target)"""

oracle("funnel", SCORED + """
SELECT count(*) AS total, count(*) FILTER (WHERE NOT below_target) AS at_target,
       count(*) FILTER (WHERE below_target) AS below,
       count(*) FILTER (WHERE below_target AND epc_reachable) AS reachable,
       count(*) FILTER (WHERE below_target AND NOT epc_reachable) AS not_reachable,
       round(count(*) FILTER (WHERE NOT below_target) / count(*) * 100, 1) AS pct_at_target,
       round(count(*) FILTER (WHERE below_target) / count(*) * 100, 1) AS pct_below,
       round(count(*) FILTER (WHERE below_target AND epc_reachable)
             / nullif(count(*) FILTER (WHERE below_target), 0) * 100, 1) AS pct_reachable
FROM scored""")

oracle("gap_percentiles", SCORED + """
SELECT count(*) AS n, round(avg(gap), 1) AS mean_gap, round(quantile_cont(gap, 0.5), 2) AS median_gap,
       round(quantile_cont(gap, 0.9), 2) AS p90_gap
FROM below""")

oracle("age_distribution", SCORED + f"""
SELECT age_group, count(*) AS n_properties,
       round(avg(CASE WHEN epc_reachable THEN 1.0 ELSE 0.0 END) * 100, 1) AS pct_reachable,
       round(avg(gap), 1) AS avg_gap, CAST({_ORDER} AS INTEGER) AS display_order
FROM below GROUP BY age_group""")

oracle("reachability_shares", SCORED + """
SELECT borough, count(*) FILTER (WHERE NOT below_target) AS already_c,
       count(*) FILTER (WHERE below_target AND epc_reachable) AS can_reach,
       count(*) FILTER (WHERE below_target AND NOT epc_reachable) AS cannot_reach, count(*) AS total,
       count(*) FILTER (WHERE NOT below_target) / count(*) * 100 AS pct_already_c,
       count(*) FILTER (WHERE below_target AND epc_reachable) / count(*) * 100 AS pct_can_reach,
       count(*) FILTER (WHERE below_target AND NOT epc_reachable) / count(*) * 100 AS pct_cannot_reach
FROM scored GROUP BY borough""")

ATTR = SCORED + f"""
, srecs AS (SELECT *, {age_group_sql('construction_age_band')} AS age_group FROM joined)
, freq AS (SELECT improvement_type, count(*) AS n_rows FROM srecs WHERE improvement_type IS NOT NULL
           GROUP BY improvement_type HAVING count(*) >= {fixed.MIN_TYPE_FREQ})
, tpc AS (SELECT improvement_type, count(DISTINCT certificate_id) AS n_properties FROM srecs
          WHERE epc_score < {_T} AND improvement_type IS NOT NULL GROUP BY improvement_type)
, pres AS (SELECT DISTINCT certificate_id, improvement_type FROM srecs
           WHERE improvement_type IN (SELECT improvement_type FROM freq))
, kk AS (SELECT certificate_id, count(*) AS k FROM pres GROUP BY certificate_id)
, ucerts AS (SELECT certificate_id, epc_potential - epc_score AS uplift,
                    {age_group_sql('construction_age_band')} AS age_group
             FROM cert_silver WHERE epc_score IS NOT NULL AND epc_potential IS NOT NULL
               AND epc_potential - epc_score >= 0)
, shares AS (SELECT p.improvement_type, u.age_group, CAST(round(u.uplift * 100 / kk.k, 0) AS BIGINT) AS share_c
             FROM pres p JOIN kk ON p.certificate_id = kk.certificate_id
             JOIN ucerts u ON p.certificate_id = u.certificate_id)
, by_age AS (SELECT improvement_type, age_group, sum(share_c) AS s, count(*) AS c FROM shares
             GROUP BY improvement_type, age_group)
, overall AS (SELECT improvement_type, round(sum(s) / sum(c), 0) / 100 AS overall_avg_pts,
                     CAST(sum(c) AS BIGINT) AS n_present
              FROM by_age GROUP BY improvement_type HAVING sum(c) >= {fixed.MIN_PRESENT_ROWS})
, attr AS (SELECT b.improvement_type, b.age_group, round(b.s / b.c, 0) / 100 AS avg_pts, o.overall_avg_pts
           FROM by_age b JOIN overall o ON b.improvement_type = o.improvement_type)
, attr_wide AS (
  SELECT a.improvement_type, a.overall_avg_pts, coalesce(t.n_properties, 0) AS n_properties,
         {", ".join(f"max(CASE WHEN a.age_group = {q(g)} THEN a.avg_pts END) AS {age_column(g)}" for g in fixed.AGE_ORDER)}
  FROM attr a LEFT JOIN tpc t ON a.improvement_type = t.improvement_type
  GROUP BY a.improvement_type, a.overall_avg_pts, t.n_properties)"""

oracle("frequent_types", ATTR + "\nSELECT * FROM freq")
oracle("type_property_counts", ATTR + "\nSELECT * FROM tpc")
oracle("attribution_by_age", ATTR + "\nSELECT * FROM attr_wide")
oracle("cost_efficiency", ATTR + f"""
, costs AS (SELECT improvement_type, avg(cost_low) AS cost_low, avg(cost_mid) AS cost_mid, avg(cost_high) AS cost_high
            FROM srecs GROUP BY improvement_type)
, ce AS (SELECT w.improvement_type, w.overall_avg_pts, w.n_properties, c.cost_low, c.cost_mid, c.cost_high,
                round(c.cost_mid / w.overall_avg_pts, 0) AS per_point_mid,
                round(c.cost_low / w.overall_avg_pts, 0) AS per_point_low,
                round(c.cost_high / w.overall_avg_pts, 0) AS per_point_high
         FROM attr_wide w LEFT JOIN costs c ON w.improvement_type = c.improvement_type
         WHERE w.overall_avg_pts > 0)
SELECT improvement_type, overall_avg_pts, n_properties, round(cost_low, 2) AS cost_low,
       round(cost_mid, 2) AS cost_mid, round(cost_high, 2) AS cost_high, per_point_mid, per_point_low,
       per_point_high, {money_range_sql('cost_mid', 'cost_low', 'cost_high')} AS cost_range,
       {money_range_sql('per_point_mid', 'per_point_low', 'per_point_high')} AS per_point_range
FROM ce""")

_CLS = [q(c) for c in fixed.PROPERTY_CLASSES]
GREEDY = ATTR + f"""
, lk_age AS (SELECT improvement_type, age_group, avg_pts AS u_age FROM attr WHERE avg_pts > 0)
, types AS (SELECT DISTINCT improvement_type, overall_avg_pts FROM attr)
, lk_type AS (SELECT improvement_type, overall_avg_pts AS u_type FROM types WHERE overall_avg_pts > 0)
, glob_med AS (SELECT quantile_cont(overall_avg_pts, 0.5) AS u_global FROM types)
, cand AS (SELECT *, {_T} - epc_score AS gap FROM srecs WHERE epc_score < {_T} AND epc_potential >= {_T})
, est AS (SELECT c.*, coalesce(a.u_age, t.u_type, (SELECT u_global FROM glob_med)) AS est_uplift
          FROM cand c
          LEFT JOIN lk_age a ON c.improvement_type = a.improvement_type AND c.age_group = a.age_group
          LEFT JOIN lk_type t ON c.improvement_type = t.improvement_type)
, est2 AS (SELECT *, CAST(round(est_uplift * 100) AS BIGINT) AS est_c,
                  CASE WHEN est_uplift > 0 AND cost_mid IS NOT NULL THEN cost_mid / est_uplift
                       ELSE CAST('inf' AS DOUBLE) END AS cost_per_pt
           FROM est)
, ranked AS (SELECT *, sum(est_c) OVER w AS cum_c, row_number() OVER w - 1 AS row_rank FROM est2
             WINDOW w AS (PARTITION BY certificate_id ORDER BY cost_per_pt ASC, improvement_type ASC NULLS LAST,
                          priority ASC NULLS LAST, cost_low ASC NULLS LAST, cost_high ASC NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
, covered AS (SELECT *, min(CASE WHEN cum_c >= gap * 100 THEN row_rank END)
                         OVER (PARTITION BY certificate_id) AS cover_rank FROM ranked)
, grows AS (SELECT *, coalesce(row_rank <= cover_rank, false) AS selected FROM covered)
, greedy AS (SELECT certificate_id, coalesce(sum(cost_low), 0) AS greedy_cost_low,
                    coalesce(sum(cost_mid), 0) AS greedy_cost_mid, coalesce(sum(cost_high), 0) AS greedy_cost_high,
                    count(improvement_type) AS n_recs_needed
             FROM grows WHERE selected GROUP BY certificate_id)
, hasr AS (SELECT DISTINCT certificate_id FROM grows)
, props AS (
  SELECT b.*, g.greedy_cost_low, g.greedy_cost_mid, g.greedy_cost_high, g.n_recs_needed,
         g.certificate_id IS NOT NULL AS has_greedy, h.certificate_id IS NOT NULL AS has_recs,
         CASE WHEN NOT b.epc_reachable THEN {_CLS[0]} WHEN h.certificate_id IS NULL THEN {_CLS[1]}
              WHEN g.certificate_id IS NULL THEN {_CLS[2]} WHEN g.greedy_cost_mid > {_CAP} THEN {_CLS[3]}
              ELSE {_CLS[4]} END AS category
  FROM below b LEFT JOIN greedy g ON b.certificate_id = g.certificate_id
  LEFT JOIN hasr h ON b.certificate_id = h.certificate_id)"""

oracle("greedy_cover", GREEDY + "\nSELECT * FROM greedy")
oracle("greedy_headline", GREEDY + f"""
SELECT count(*) AS n_covered, round(avg(greedy_cost_mid), 0) AS mean_cost_mid,
       round(count(*) FILTER (WHERE greedy_cost_mid > {_CAP}) / count(*) * 100, 1) AS pct_over_cap,
       round(avg(n_recs_needed), 1) AS avg_recs, round(quantile_cont(greedy_cost_mid, 0.5), 0) AS median_cost_mid
FROM greedy""")
oracle("property_class_counts", GREEDY + "\nSELECT category AS value, count(*) AS count FROM props GROUP BY category")
oracle("area_greedy_summary", GREEDY + f"""
, at_c AS (SELECT borough, count(*) AS already_at_c FROM scored WHERE NOT below_target GROUP BY borough)
, summ AS (
  SELECT borough, count(*) AS below_c, count(*) FILTER (WHERE epc_reachable) AS n_epc_reachable,
         count(*) FILTER (WHERE greedy_cost_mid > {_CAP}) AS n_over_10k, round(avg(gap), 1) AS avg_gap,
         round(avg(n_recs_needed), 1) AS avg_recs_to_c,
         round(quantile_cont(greedy_cost_low, 0.5), 0) AS median_cost_low,
         round(quantile_cont(greedy_cost_mid, 0.5), 0) AS median_cost_mid,
         round(quantile_cont(greedy_cost_high, 0.5), 0) AS median_cost_high
  FROM props GROUP BY borough)
SELECT s.*, a.already_at_c, round(s.n_epc_reachable / s.below_c * 100, 1) AS pct_reachable,
       round(s.n_over_10k / nullif(s.n_epc_reachable, 0) * 100, 1) AS pct_over_10k,
       {money_range_sql('s.median_cost_mid', 's.median_cost_low', 's.median_cost_high')} AS cost_range
FROM summ s LEFT JOIN at_c a ON s.borough = a.borough""")
oracle("age_cost_stats", GREEDY + f"""
SELECT age_group, round(avg(CASE WHEN greedy_cost_mid <= {_CAP} THEN 1.0 ELSE 0.0 END) * 100, 1) AS pct_within_10k,
       round(quantile_cont(greedy_cost_mid, 0.5), 2) AS median_cost_mid, CAST({_ORDER} AS INTEGER) AS display_order
FROM props WHERE epc_reachable AND has_greedy AND age_group IN {inlist(fixed.AGE_ORDER)}
GROUP BY age_group""")


# ---------------------------------------------------------------- data quality
# written out here, not read from the checked code: (rule, column[, bounds])
_RULES = {
    "certificates": ["not_null certificate_id", "unique certificate_id", "not_null borough", "accepted_range epc_score 1 100",
                     "accepted_range floor_area_m2 0 -"],
    "area_quality": ["not_null borough", "unique borough", "not_null social_properties", "accepted_range social_properties 1 -",
                     "not_null pct_below_epc_c", "accepted_range pct_below_epc_c 0 100", "accepted_range avg_epc_score 0 100",
                     "accepted_range pct_pre_1950 0 100"],
    "area_deprivation": ["not_null la_name", "unique la_name", "not_null imd_score", "accepted_range imd_score 0 -",
                         "not_null income_deprivation_rate", "accepted_range income_deprivation_rate 0 1", "accepted_range lsoa_count 1 -"],
    "area_priority": ["row_count 20", "not_null borough", "unique borough", "not_null priority_rank", "accepted_range priority_rank 1 20",
                      "not_null priority_score", "accepted_range priority_score 1 -",
                      "not_null pct_below_epc_c", "accepted_range pct_below_epc_c 0 100",
                      "not_null income_deprivation_rate", "accepted_range income_deprivation_rate 0 1",
                      "not_null pct_pre_1950", "accepted_range pct_pre_1950 0 100"],
    "retrofit_costs": ["not_null borough", "unique borough", "not_null total_recommendations", "accepted_range total_recommendations 1 -",
                       "accepted_range avg_cost_per_recommendation 0 -", "accepted_range total_indicative_cost_m 0 -"],
    "retrofit_scenarios": ["not_null borough", "unique borough", "not_null properties_with_recs", "accepted_range properties_with_recs 1 -",
                           "accepted_range per_home_optimistic 0 -", "accepted_range per_home_central 0 -",
                           "accepted_range per_home_pessimistic 0 -",
                           "ordered per_home_optimistic per_home_central per_home_pessimistic",
                           "ordered total_optimistic_m total_central_m total_pessimistic_m", "accepted_range uncertainty_pct 0 -"],
    "wall_split": ["not_null borough", "unique borough", "not_null pct_solid_wall", "accepted_range pct_solid_wall 0 100",
                   "accepted_range pct_cavity_wall 0 100", "sums_to pct_solid_wall pct_cavity_wall"],
    "reachability_shares": ["unique borough", "sums_to pct_already_c pct_can_reach pct_cannot_reach"],
}


def _viol(rule: str) -> tuple[str, str, str]:
    kind, *a = rule.split()
    if kind == "not_null":
        return kind, a[0], f"count(*) FILTER (WHERE {a[0]} IS NULL)"
    if kind == "unique":
        return kind, a[0], f"count({a[0]}) - count(DISTINCT {a[0]})"
    if kind == "accepted_range":
        c, lo, hi = a
        conds = ["false"] + [f"{c} < {lo}"] * (lo != "-") + [f"{c} > {hi}"] * (hi != "-")
        return kind, c, f"count(*) FILTER (WHERE coalesce({' OR '.join(conds)}, false))"
    if kind == "ordered":
        conds = " OR ".join(f"{x} > {y}" for x, y in zip(a, a[1:]))
        return kind, "<=".join(a), f"count(*) FILTER (WHERE coalesce(false OR {conds}, false))"
    if kind == "sums_to":
        total = " + ".join(f"coalesce({c}, 0.0)" for c in a)
        return kind, "+".join(a), f"count(*) FILTER (WHERE abs({total} - 100) > 0.15)"
    if kind == "row_count":
        return kind, "*", f"abs(count(*) - {a[0]})"
    raise ValueError(kind)


_QTABLES = {
    "certificates": "cert_silver", "area_quality": "area_quality", "retrofit_costs": "q_cost", "area_deprivation": "area_deprivation", "area_priority": "priority",
    "retrofit_scenarios": "q_scen", "wall_split": "q_wall", "reachability_shares": "q_reach",
}
_checks = []
for _t, _rules in _RULES.items():
    for _r in _rules:
        _k, _c, _v = _viol(_r)
        _checks.append(f"SELECT {q(_t)} AS table_name, {q(_k)} AS rule, {q(_c)} AS column_name, "
                       f"count(*) AS n_rows, CAST({_v} AS BIGINT) AS n_violations, "
                       f"CAST({_v} AS BIGINT) = 0 AS passed FROM {_QTABLES[_t]}")
oracle("quality_report", ENRICHED + PRIORITY + SCORED + """
, q_cost AS (
  SELECT borough, count(*) AS total_recommendations, round(avg(cost_mid), 0) AS avg_cost_per_recommendation,
         round(sum(cost_mid) / 1e6, 2) AS total_indicative_cost_m FROM jx GROUP BY borough)
, q_scen AS (
  SELECT borough, count(DISTINCT certificate_id) AS properties_with_recs, round(sum(cost_low) / 1e6, 2) AS total_optimistic_m, round(sum(cost_mid) / 1e6, 2) AS total_central_m,
         round(sum(cost_high) / 1e6, 2) AS total_pessimistic_m,
         round(sum(cost_low) / count(DISTINCT certificate_id), 0) AS per_home_optimistic,
         round(sum(cost_mid) / count(DISTINCT certificate_id), 0) AS per_home_central,
         round(sum(cost_high) / count(DISTINCT certificate_id), 0) AS per_home_pessimistic,
         round((sum(cost_high) - sum(cost_low)) / nullif(sum(cost_mid), 0) * 100, 1) AS uncertainty_pct
  FROM jx GROUP BY borough)
, q_wall0 AS (SELECT borough, sum(CASE WHEN improvement_id = 6 THEN 1 ELSE 0 END) AS cav,
                     sum(CASE WHEN improvement_id = 7 THEN 1 ELSE 0 END) AS sol FROM jx GROUP BY borough)
, q_wall AS (SELECT borough, round(sol / nullif(cav + sol, 0) * 100, 1) AS pct_solid_wall,
                    round(cav / nullif(cav + sol, 0) * 100, 1) AS pct_cavity_wall FROM q_wall0 WHERE cav + sol > 0)
, q_reach AS (
  SELECT borough, count(*) FILTER (WHERE NOT below_target) / count(*) * 100 AS pct_already_c,
         count(*) FILTER (WHERE below_target AND epc_reachable) / count(*) * 100 AS pct_can_reach,
         count(*) FILTER (WHERE below_target AND NOT epc_reachable) / count(*) * 100 AS pct_cannot_reach
  FROM scored GROUP BY borough)
""" + "\nUNION ALL\n".join(_checks))


# ---------------------------------------------------------------- area statistics (M1-M3)
AREA_FEAT = AREAS + """
, wall_a AS (
  SELECT borough, round(sol / nullif(cav + sol, 0) * 100, 1) AS pct_solid_wall FROM (
    SELECT borough, sum(CASE WHEN improvement_id = 6 THEN 1 ELSE 0 END) AS cav,
           sum(CASE WHEN improvement_id = 7 THEN 1 ELSE 0 END) AS sol FROM jx GROUP BY borough)
  WHERE cav + sol > 0)
, af AS (SELECT p.*, w.pct_solid_wall FROM priority p LEFT JOIN wall_a w ON p.borough = w.borough
         WHERE p.pct_below_epc_c IS NOT NULL AND p.income_deprivation_rate IS NOT NULL
           AND w.pct_solid_wall IS NOT NULL)"""
_AF = ["pct_below_epc_c", "income_deprivation_rate", "pct_solid_wall"]
oracle("corr_matrix", ENRICHED + AREA_FEAT + "\n" + " UNION ALL ".join(
    [f"SELECT {q(a)} AS x, {q(b)} AS y, round(corr({a}, {b}), 6) AS r FROM af" for a in _AF for b in _AF]
    + ["SELECT 'pct_below_epc_c' AS x, 'pct_pre_1950' AS y, round(corr(pct_below_epc_c, pct_pre_1950), 6) AS r FROM af"]))
oracle("regression_line", ENRICHED + AREA_FEAT + """
SELECT round(regr_slope(pct_below_epc_c, pct_solid_wall), 6) AS slope,
       round(regr_intercept(pct_below_epc_c, pct_solid_wall), 6) AS intercept,
       round(corr(pct_solid_wall, pct_below_epc_c), 6) AS r,
       CAST(regr_count(pct_below_epc_c, pct_solid_wall) AS BIGINT) AS n
FROM af""")
oracle("standardised", ENRICHED + AREA_FEAT + "\nSELECT borough, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}_z" for c in _AF) + " FROM af")


# ---------------------------------------------------------------- checks beside the models
oracle("component_check", ENRICHED + AREA_FEAT + """
SELECT count(*) AS n_areas, CAST(0 AS BIGINT) AS n_wrong_scores, CAST(0 AS BIGINT) AS n_wrong_ranks,
       CAST(0 AS BIGINT) AS n_not_orthonormal, CAST(1 AS DOUBLE) AS variance_share FROM af""")
oracle("tier_check", ENRICHED + AREA_FEAT + """
SELECT count(*) AS n_areas, CAST(0 AS BIGINT) AS n_not_nearest, CAST(0 AS BIGINT) AS n_misplaced_tiers FROM af""")
oracle("sweep_check", ENRICHED + AREA_FEAT + """
SELECT k, count(*) AS n_areas, CAST(k AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_not_nearest, CAST(0 AS BIGINT) AS n_wrong_inertia
FROM af, (SELECT CAST(unnest([2, 3, 4, 5, 6, 7]) AS INTEGER) AS k) GROUP BY k""")
oracle("ward_check", ENRICHED + AREA_FEAT + """
SELECT count(*) - 1 AS n_merges, CAST(0 AS BIGINT) AS n_falling, round(3e0 * count(*), 6) AS spread, count(*) AS n_areas,
       CAST(3 AS BIGINT) AS tiers_3, CAST(4 AS BIGINT) AS tiers_4, CAST(4 AS BIGINT) AS nested FROM af""")
_UPLIFT = """
, up AS (SELECT certificate_id, epc_potential - epc_score AS uplift, coalesce(construction_age_band, 'Unknown') AS age_band,
                coalesce(property_type, 'Unknown') AS prop_type
         FROM cert_silver WHERE epc_score IS NOT NULL AND epc_potential IS NOT NULL AND epc_potential - epc_score >= 0)"""
oracle("ordinal_codes", _UPLIFT + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS label, CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS BIGINT) AS code FROM (SELECT DISTINCT {c} FROM up)"
    for c in ("age_band", "prop_type")))
oracle("forest_check", _UPLIFT + """
SELECT CAST(100 AS BIGINT) AS n_trees, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_lost_rows, CAST(0 AS BIGINT) AS n_wrong_nodes,
       CAST(0 AS BIGINT) AS n_small_leaves, CAST(0 AS BIGINT) AS n_too_deep, CAST(0 AS BIGINT) AS n_other_prediction FROM up""")
oracle("metrics_check", _UPLIFT + """
SELECT count(*) AS n_test, CAST(0 AS BIGINT) AS wrong_mae, CAST(0 AS BIGINT) AS wrong_r2, CAST(0 AS BIGINT) AS wrong_within,
       CAST(0 AS BIGINT) AS wrong_baseline, CAST(0 AS BIGINT) AS worse_than_mean
FROM up WHERE CAST('0x' || substr(md5(certificate_id), 1, 6) AS BIGINT) % 5 = 0""")
_HOT = _UPLIFT + """
, frequent AS (SELECT improvement_type FROM joined WHERE improvement_type IS NOT NULL GROUP BY improvement_type HAVING count(*) >= 500)
, ones AS (SELECT DISTINCT u.certificate_id, j.improvement_type FROM up u JOIN joined j ON u.certificate_id = j.certificate_id
           JOIN frequent f ON j.improvement_type = f.improvement_type)"""
oracle("model_tables_check", _HOT + """
SELECT CAST(0 AS BIGINT) AS n_wrong_cells, (SELECT count(*) FROM (SELECT improvement_type FROM ones GROUP BY 1 HAVING count(*) >= 30)) AS n_types,
       CAST(0 AS BIGINT) AS n_wrong_covers, count(DISTINCT borough) AS n_areas, CAST(count(*) AS BIGINT) AS n_below
FROM cert_silver WHERE epc_score < 69""")
oracle("agreement_check", ENRICHED + AREA_FEAT + """
SELECT count(*) AS n_areas, CAST(0 AS BIGINT) AS n_wrong_flags, CAST(0 AS BIGINT) AS n_wrong_silhouettes, CAST(0 AS BIGINT) AS n_wrong_profiles,
       CAST(0 AS BIGINT) AS n_out_of_order, CAST(0 AS BIGINT) AS n_wrong_signs FROM af""")
oracle("hot_fill_check", _HOT + """
SELECT (SELECT count(*) FROM up) AS n_rows, (SELECT count(*) FROM frequent) AS n_types, (SELECT count(*) FROM ones) AS n_ones,
       (SELECT count(*) FROM up) * (SELECT count(*) FROM frequent) - (SELECT count(*) FROM ones) AS n_zeros, CAST(0 AS BIGINT) AS n_nulls""")
oracle("split_check", _UPLIFT + """
, folds AS (SELECT uplift, CAST('0x' || substr(md5(certificate_id), 1, 6) AS BIGINT) % 5 AS fold FROM up)
, train AS (SELECT count(*) AS n, avg(uplift) AS mean FROM folds WHERE fold <> 0)
SELECT (SELECT n FROM train) AS n_train, count(*) AS n_test, round(avg(abs(uplift - (SELECT mean FROM train))), 6) AS baseline_mae
FROM folds WHERE fold = 0""")


# ---------------------------------------------------------------- multi-hot (A38): dynamic pivot
oracle("multi_hot", ATTR + """
SELECT DISTINCT s.certificate_id, s.improvement_type FROM srecs s JOIN freq f ON s.improvement_type = f.improvement_type""")

oracle("attribution_check", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_not_additive, CAST(0 AS BIGINT) AS n_not_the_forest
FROM cert_silver WHERE epc_score IS NOT NULL AND epc_potential IS NOT NULL AND epc_potential - epc_score >= 0""")


# ---------------------------------------------------------------- raw-file ingest and exports
oracle("certificates_from_csv", """
SELECT certificate_id, nullif(uprn, '') AS uprn, borough, epc_rating, epc_score, inspection_date, inspection_year,
       below_epc_c, fuel_category, construction_age_band
FROM cert_silver""")
oracle("recommendations_from_csv", """
SELECT certificate_id, priority, improvement_id, improvement_type, indicative_cost, cost_low, cost_mid, cost_high FROM recs""")
ORACLE["deprivation_from_csv"] = ORACLE["area_deprivation"]
ORACLE["export_roundtrip"] = ORACLE["retrofit_costs"]
ORACLE["retrofit_costs_sql"] = ORACLE["retrofit_costs_from_views"] = ORACLE["retrofit_costs_catalog"] = ORACLE["retrofit_costs"]


# ---------------------------------------------------------------- region lookup, semi-join scope, recent periods
_RN = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in fixed.REGION_NAMES.items())
oracle("region_counts", f"""
SELECT value, count, CASE value {_RN} ELSE 'Unknown' END AS region_name FROM (
  SELECT region AS value, count(*) AS count FROM raw_cert GROUP BY region
  ORDER BY count DESC, value ASC NULLS LAST LIMIT 10)""")
oracle("scoped_recommendations", """
SELECT certificate_id, priority, improvement_type, indicative_cost FROM recs
WHERE certificate_id IN (SELECT certificate_id FROM cert_silver)""")
oracle("recent_affordability", """
SELECT * FROM (
  SELECT year, count(*) AS lettings, round(avg(weekly_rent_est), 2) AS avg_weekly_rent,
         round(avg(weekly_income_est), 2) AS avg_weekly_income,
         round(avg(rent_to_income_pct), 1) AS avg_rent_to_income_pct,
         round(sum(CASE WHEN rent_to_income_pct > 50 THEN 1 ELSE 0 END) / count(*) * 100, 1) AS pct_spending_over_50pct_on_rent,
         round(sum(CASE WHEN overcrowded THEN 1 ELSE 0 END) / count(*) * 100, 1) AS pct_overcrowded
  FROM lettings_silver WHERE weekly_rent_est IS NOT NULL AND weekly_income_est IS NOT NULL
  GROUP BY year) ORDER BY year DESC LIMIT 3""")
