"""DuckDB SQL for the derived raw inputs and the silver tables.

This is the oracle side: written independently of the Spark plans (e.g. the
latest-record step is the plain ``row_number`` window here, an aggregate in
the Spark plan) so the comparison checks the Spark jobs. Only the binding
labels are shared, since both sides must derive the same raw input.
"""

from __future__ import annotations

from hearth.functions import fixed
from hearth.sources import bronze as B


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(items) -> str:
    return "[" + ", ".join(q(x) if isinstance(x, str) else str(x) for x in items) + "]"


def inlist(items) -> str:
    return "(" + ", ".join(q(x) for x in items) + ")"


def fmt(x: str) -> str:
    return f"('£' || format('{{:,}}', {x}))"


RAW_CERT = f"""
raw_cert_src AS (
  SELECT o.o_orderkey AS ok, o.o_custkey AS ck, o.o_orderstatus AS st, o.o_orderdate AS od,
         n.n_nationkey AS nk, n.n_name AS nn,
         20 + (o.o_orderkey * 13 + o.o_custkey * 7) % 75 AS score
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw_cert AS (
  SELECT
    'C' || ok::VARCHAR AS certificate_number,
    CASE WHEN ck % 40 = 0 THEN NULL WHEN ck % 40 = 1 THEN ''
         ELSE 'U' || ck::VARCHAR || '-' || (ok % 8)::VARCHAR END AS uprn,
    CASE WHEN ck % 80 = 0 THEN NULL ELSE 'PC' || (ck % 97)::VARCHAR || ' ' || (ok % 8)::VARCHAR || 'AA' END AS postcode,
    CASE WHEN ck % 80 = 0 THEN NULL ELSE ck::VARCHAR || ' TEST STREET' END AS address1,
    'E09' || lpad(nk::VARCHAR, 6, '0') AS local_authority,
    CASE WHEN ok % 11 = 0 THEN nn || ' ' ELSE nn END AS local_authority_label,
    CASE WHEN st = 'F' THEN 'rental (social)'
         WHEN st = 'P' THEN CASE WHEN ok % 2 = 0 THEN 'SOCIAL RENTED' ELSE 'Rented (Social)' END
         ELSE {lst(("owner-occupied", "Rented (Social)", "rental (private)"))}[ok % 3 + 1] END AS tenure,
    {lst(B.PROPERTY_TYPES)}[ck % 4 + 1] AS property_type,
    {lst(B.BUILT_FORMS)}[ck % 5 + 1] AS built_form,
    {lst(B.AGE_BANDS)}[ck % 13 + 1] AS construction_age_band,
    CASE WHEN ok % 29 = 0 THEN NULL WHEN score >= 92 THEN 'A' WHEN score >= 81 THEN 'B'
         WHEN score >= 69 THEN 'C' WHEN score >= 55 THEN 'D' WHEN score >= 39 THEN 'E'
         WHEN score >= 21 THEN 'F' ELSE 'G' END AS current_energy_rating,
    score::VARCHAR AS current_energy_efficiency,
    CASE WHEN ok % 19 = 0 THEN NULL WHEN ok % 43 = 0 THEN (score - 3)::VARCHAR
         ELSE least(100, score + (ok * 7) % 41)::VARCHAR END AS potential_energy_efficiency,
    (30 + ck % 90)::VARCHAR AS total_floor_area,
    CASE WHEN ok % 8 = 7 THEN NULL ELSE {lst(B.FUEL_LABELS)}[ok % 8 + 1] END AS main_fuel,
    (CAST(ok % 64 AS DOUBLE) / 8)::VARCHAR AS co2_emissions_current,
    (100 + ok % 300)::VARCHAR AS energy_consumption_current,
    (300 + ck % 900)::VARCHAR AS heating_cost_current,
    {lst(B.EFFICIENCY)}[ok % 5 + 1] AS walls_energy_eff,
    {lst(B.EFFICIENCY)}[(ok + 1) % 5 + 1] AS roof_energy_eff,
    {lst(B.EFFICIENCY)}[(ok + 2) % 5 + 1] AS windows_energy_eff,
    CASE WHEN ok % 8 < 3 THEN 'Y' ELSE 'N' END AS mains_gas_flag,
    CASE WHEN ok % 37 = 0 THEN '' ELSE strftime(CAST(od AS DATE) + INTERVAL 20 YEAR, '%Y-%m-%d') END AS inspection_date,
    CASE WHEN ck % 23 = 0 THEN 'E12000002' ELSE 'E12000007' END AS region
  FROM raw_cert_src
)"""

_TEXTS = lst([s for s, _ in B.REC_TYPES])
_IDS = lst([i for _, i in B.REC_TYPES])

RAW_REC = f"""
raw_rec_src AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_partkey % 100 < 2 THEN {B.N_COMMON} WHEN l_partkey % 100 = 2 THEN NULL
              WHEN l_partkey % 100 < 5 THEN {B.N_COMMON + 1} ELSE (l_partkey % 100 - 5) % {B.N_COMMON} END AS t,
         25 * (1 + (l_partkey * 7 + l_suppkey * 3) % 400) AS lo,
         25 * (1 + (l_partkey * 7 + l_suppkey * 3) % 400) + 25 * (l_suppkey % 30) AS hi
  FROM lineitem
),
raw_rec AS (
  SELECT 'C' || l_orderkey::VARCHAR AS certificate_number,
         l_linenumber::VARCHAR AS improvement_item,
         ({_IDS}[t + 1])::VARCHAR AS improvement_id,
         {_TEXTS}[t + 1] AS improvement_summary_text,
         CASE WHEN l_suppkey % 47 = 0 THEN NULL
              WHEN l_partkey % 61 = 0 THEN {fmt('lo')} || ' - ' || {fmt('hi')} || ' (' || {fmt('lo + 25')} || ' typical)'
              WHEN hi = lo THEN {fmt('lo')}
              ELSE {fmt('lo')} || ' - ' || {fmt('hi')} END AS indicative_cost
  FROM raw_rec_src
)"""

RAW_IMD = f"""
raw_imd AS (
  SELECT CASE WHEN n.n_regionkey = 4 THEN 'E08' ELSE 'E09' END || lpad(n.n_nationkey::VARCHAR, 6, '0') AS "{B.IMD_CODE}",
         lower(n.n_name) AS "{B.IMD_NAME}",
         CAST((c.c_custkey * 37) % 4096 AS DOUBLE) / 64 AS "{B.IMD_SCORE}",
         CAST((c.c_custkey * 53) % 1024 AS DOUBLE) / 2048 AS "{B.IMD_INCOME}",
         CAST((c.c_custkey * 29) % 1024 AS DOUBLE) / 4096 AS "{B.IMD_EMPLOY}",
         CAST((c.c_custkey * 17) % 512 - 256 AS DOUBLE) / 128 AS "{B.IMD_HEALTH}",
         CAST((c.c_custkey * 11) % 4096 AS DOUBLE) / 64 AS "{B.IMD_LIVING}"
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

CERT_SILVER = f"""
cert_scope AS (
  SELECT trim(certificate_number) AS certificate_id, trim(uprn) AS uprn, trim(postcode) AS postcode,
         trim(address1) AS address1, trim(local_authority) AS local_authority_code,
         trim(local_authority_label) AS borough, trim(tenure) AS tenure,
         trim(property_type) AS property_type, trim(built_form) AS built_form,
         trim(construction_age_band) AS construction_age_band, trim(current_energy_rating) AS epc_rating,
         TRY_CAST(current_energy_efficiency AS DOUBLE) AS epc_score,
         TRY_CAST(total_floor_area AS DOUBLE) AS floor_area_m2,
         TRY_CAST(co2_emissions_current AS DOUBLE) AS co2_emissions,
         TRY_CAST(energy_consumption_current AS DOUBLE) AS energy_consumption,
         TRY_CAST(heating_cost_current AS DOUBLE) AS heating_cost,
         TRY_CAST(potential_energy_efficiency AS DOUBLE) AS epc_potential,
         trim(main_fuel) AS main_fuel, trim(walls_energy_eff) AS walls_energy_eff,
         trim(roof_energy_eff) AS roof_energy_eff, trim(windows_energy_eff) AS windows_energy_eff,
         trim(mains_gas_flag) AS mains_gas_flag,
         CAST(TRY_STRPTIME(inspection_date, '%Y-%m-%d') AS DATE) AS inspection_date,
         trim(region) AS region_code
  FROM raw_cert
  WHERE upper(trim(tenure)) IN {inlist(fixed.SOCIAL_TENURES)}
    AND trim(region) = '{fixed.TARGET_REGION}'
),
cert_proj AS (SELECT * FROM cert_scope WHERE epc_rating IS NOT NULL),
cert_keyed AS (
  SELECT *, COALESCE(
      CASE WHEN uprn IS NOT NULL AND uprn <> '' THEN uprn END,
      CASE WHEN coalesce(postcode, '') = '' AND coalesce(address1, '') = '' THEN certificate_id END,
      concat_ws('|', postcode, address1)) AS dedup_key
  FROM cert_proj
),
cert_silver AS (
  SELECT * EXCLUDE (rn, dedup_key),
         CASE WHEN epc_rating IN {inlist(fixed.BELOW_C_RATINGS)} THEN TRUE ELSE FALSE END AS below_epc_c,
         CAST(year(inspection_date) AS INTEGER) AS inspection_year,
         CASE WHEN main_fuel IN {inlist(fixed.GAS_INDIVIDUAL)} THEN 'gas_individual'
              WHEN main_fuel = {q(fixed.GAS_COMMUNITY)} THEN 'gas_community'
              WHEN main_fuel IN {inlist(fixed.ELECTRIC_INDIVIDUAL)} THEN 'electric_individual'
              WHEN main_fuel = {q(fixed.ELECTRIC_COMMUNITY)} THEN 'electric_community'
              WHEN main_fuel IS NOT NULL THEN 'other' END AS fuel_category
  FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key
                  ORDER BY inspection_date DESC NULLS LAST, certificate_id DESC) AS rn
        FROM cert_keyed)
  WHERE rn = 1
)"""

# Cost text -> low/mid/high (helper rule: 1 number -> all equal; 2 -> low, mean, high;
# 0 or >= 3 numbers -> mid/high NULL).
RECS = """
rec_nums AS (
  SELECT *, regexp_extract_all(coalesce(indicative_cost, ''), '[\\d,]+') AS nums FROM raw_rec
),
recs AS (
  SELECT certificate_number AS certificate_id,
         TRY_CAST(TRY_CAST(nullif(trim(improvement_item), '') AS DOUBLE) AS INTEGER) AS priority,
         TRY_CAST(TRY_CAST(nullif(trim(improvement_id), '') AS DOUBLE) AS INTEGER) AS improvement_id,
         improvement_summary_text AS improvement_type,
         indicative_cost,
         TRY_CAST(replace(nums[1], ',', '') AS DOUBLE) AS cost_low,
         CASE len(nums) WHEN 2 THEN (TRY_CAST(replace(nums[1], ',', '') AS DOUBLE)
                                     + TRY_CAST(replace(nums[2], ',', '') AS DOUBLE)) / 2
                        WHEN 1 THEN TRY_CAST(replace(nums[1], ',', '') AS DOUBLE) END AS cost_mid,
         CASE len(nums) WHEN 2 THEN TRY_CAST(replace(nums[2], ',', '') AS DOUBLE)
                        WHEN 1 THEN TRY_CAST(replace(nums[1], ',', '') AS DOUBLE) END AS cost_high
  FROM rec_nums
),
joined AS (
  SELECT r.*, c.borough, c.epc_rating, c.epc_score, c.epc_potential, c.construction_age_band, c.property_type
  FROM recs r JOIN cert_silver c ON r.certificate_id = c.certificate_id
  WHERE c.borough IS NOT NULL
)"""


def categorise_sql(col: str) -> str:
    parts = []
    for label, words in fixed.CATEGORY_KEYWORDS:
        cond = " OR ".join(f"contains(lower({col}), {q(w)})" for w in words)
        parts.append(f"WHEN {cond} THEN {q(label)}")
    return (f"CASE WHEN {col} IS NULL THEN {q(fixed.OTHER_CATEGORY)} " + " ".join(parts)
            + f" ELSE {q(fixed.OTHER_CATEGORY)} END")


def age_group_sql(col: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in fixed.AGE_GROUPS.items())
    return f"(CASE {col} {whens} ELSE {q(fixed.UNKNOWN)} END)"


BASE = ",\n".join([RAW_CERT, RAW_REC, RAW_IMD, CERT_SILVER, RECS])


def sql(body: str) -> str:
    """Full query: all base CTEs, then ``body`` (which may start with more CTEs
    as ', name AS (...)' and must end with a SELECT)."""
    body = body.strip()
    if body.startswith(","):
        return "WITH " + BASE + body
    return "WITH " + BASE + "\n" + body


def _band_sql(x: str, width: int, top: int, e: str, missing: str) -> str:
    lo = f"(CAST(floor({x} / {width}) AS BIGINT) * {width} + 1)"
    return (f"CASE WHEN {e} % 29 = 0 THEN {q(missing)} WHEN {e} % 37 = 0 THEN '' "
            f"WHEN {x} >= {top} THEN 'More than ' || format('{{:,}}', {top}) "
            f"WHEN {x} < {width} THEN 'Less than {width}' "
            f"WHEN {e} % 41 = 0 THEN CAST(floor({x}) AS BIGINT)::VARCHAR "
            f"ELSE format('{{:,}}', {lo}) || ' to ' || format('{{:,}}', {lo} + {width - 1}) END")


RAW_LETTINGS = f"""
raw_lettings AS (
  SELECT event_type AS variant,
         CASE WHEN event_type = 'error' OR user_id % 10 = 0 THEN 'E12000002'
              WHEN 2007 + event_id % 16 < 2012 THEN '7' ELSE 'E12000007' END
           || CASE WHEN event_id % 17 = 0 THEN ' ' ELSE '' END AS GOVREG,
         (2007 + event_id % 16)::VARCHAR AS YEAR,
         {lst(B.LET_TYPES)}[event_id % 2 + 1] AS LETTYPE,
         {lst(B.TENANCIES)}[user_id % 4 + 1] AS TENANCY,
         CASE WHEN event_id % 31 = 0 THEN '' ELSE (1 + user_id % 6)::VARCHAR END AS HHMEMBT,
         (1 + user_id % 4)::VARCHAR || CASE WHEN event_id % 13 = 0 THEN '.0' ELSE '' END AS BEDST,
         CASE WHEN event_id % 23 = 0 THEN ' ' ELSE (event_id % 5 - 2)::VARCHAR END AS BED_MINUS_BEDSTANDARD,
         {lst(B.PREV_TENURES)}[user_id % 5 + 1] AS PREVTEN_R,
         {lst(B.REASONS)}[event_id % 5 + 1] AS REASON_R,
         {_band_sql('value * 3', 50, 1000, 'event_id', 'Missing')} AS WEEKINC_T_Bands,
         {_band_sql('value * 1.5', 25, 500, '(event_id + 7)', 'R')} AS WRENT_Bands,
         {_band_sql('value / 2', 10, 100, '(event_id + 11)', 'Refused')} AS WTSHORTFALLHB_Bands,
         {lst(B.ETHNICITIES)}[user_id % 6 + 1] AS ETHNIC_Bands,
         {lst(B.TENANCY_LENGTHS)}[event_id % 4 + 1] AS TENANCYLENGTH_Bands,
         {lst(B.EMPLOYMENT)}[(event_id + user_id) % 6 + 1] AS econstat_imputed_R
  FROM events
)"""


def band_mid_sql(col: str) -> str:
    s = f"regexp_replace({col}, '^\\s+|\\s+$', '', 'g')"
    num = lambda t: f"TRY_CAST(replace({t}, ',', '') AS DOUBLE)"
    first = f"regexp_extract({s}, '[\\d,]+')"
    part = lambda i: f"regexp_replace(split_part({s}, ' to ', {i}), '^\\s+|\\s+$', '', 'g')"
    return (f"(CASE WHEN {col} IS NULL OR {s} IN {inlist(fixed.BAND_SENTINELS)} THEN NULL "
            f"WHEN contains({s}, 'More than') OR contains({s}, 'more than') THEN {num(first)} "
            f"WHEN contains({s}, 'Less than') OR contains({s}, 'less than') THEN {num(first)} / 2 "
            f"WHEN contains({s}, ' to ') THEN ({num(part(1))} + {num(part(2))}) / 2 "
            f"ELSE {num(s)} END)")


def _sint(c: str) -> str:
    return f"TRY_CAST(TRY_CAST(nullif(trim({c}), '') AS DOUBLE) AS INTEGER)"


LETTINGS_SILVER = f"""
let_std AS (
  SELECT variant, {_sint('YEAR')} AS year, nullif(trim(LETTYPE), '') AS let_type, nullif(trim(TENANCY), '') AS tenancy_type,
         {_sint('HHMEMBT')} AS household_size, {_sint('BEDST')} AS bedroom_standard,
         CASE WHEN variant = 'click' THEN NULL ELSE {_sint('BED_MINUS_BEDSTANDARD')} END AS bedrooms_vs_need,
         nullif(trim(PREVTEN_R), '') AS previous_tenure, nullif(trim(REASON_R), '') AS reason_for_letting,
         nullif(trim(WEEKINC_T_Bands), '') AS weekly_income_band, nullif(trim(WRENT_Bands), '') AS weekly_rent_band,
         nullif(trim(WTSHORTFALLHB_Bands), '') AS rent_shortfall_band, nullif(trim(ETHNIC_Bands), '') AS ethnicity,
         CASE WHEN variant = 'click' THEN NULL ELSE trim(TENANCYLENGTH_Bands) END AS tenancy_length_band,
         CASE WHEN variant = 'click' THEN NULL ELSE trim(econstat_imputed_R) END AS employment_status
  FROM raw_lettings WHERE trim(GOVREG) IN {inlist(fixed.LETTINGS_REGION_CODES)}
),
let_est AS (
  SELECT *, '{fixed.TARGET_REGION}' AS region_code,
         {band_mid_sql('weekly_income_band')} AS weekly_income_est,
         {band_mid_sql('weekly_rent_band')} AS weekly_rent_est,
         {band_mid_sql('rent_shortfall_band')} AS rent_shortfall_est
  FROM let_std
),
lettings_silver AS (
  SELECT *, CASE WHEN weekly_income_est > 0 AND weekly_rent_est IS NOT NULL
                 THEN weekly_rent_est / weekly_income_est * 100 END AS rent_to_income_pct,
         CASE WHEN bedrooms_vs_need < 0 THEN TRUE ELSE FALSE END AS overcrowded
  FROM let_est
)"""

BASE = ",\n".join([RAW_CERT, RAW_REC, RAW_IMD, CERT_SILVER, RECS, RAW_LETTINGS, LETTINGS_SILVER])
