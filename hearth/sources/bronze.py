"""Raw ("bronze") inputs derived from the driver's tables.

The bundled data carries no building-stock files, so each raw source of the
programme is derived, by Spark, from the driver's tables so that its size
grows with them:

* certificates      <- orders ⋈ customer ⋈ nation   (one row per order)
* recommendations   <- lineitem                      (one row per line)
* deprivation areas <- customer ⋈ nation             (one row per customer)
* lettings          <- events                        (one row per event,
                       written as tab files with drifting headers)

All raw columns are strings, as when read from CSV with a header and no
inference. Every derived attribute is a value mapping of the source row; no
row is dropped here. The labels below are synthetic (this binding's own),
chosen to exercise every rule of the column jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from .tables import table

# --- binding labels (synthetic, this repository's own) -------------------
AGE_BANDS = tuple(fixed.AGE_GROUPS) + ("NO DATA!",)
PROPERTY_TYPES = ("Flat", "House", "Maisonette", "Bungalow")
BUILT_FORMS = ("Mid-Terrace", "End-Terrace", "Semi-Detached", "Detached", "Enclosed Mid-Terrace")
FUEL_LABELS = ("mains gas (not community)", "Gas: mains gas", "mains gas (community)",
               "electricity (not community)", "Electricity: electricity, unspecified tariff",
               "electricity (community)", "oil (not community)")
EFFICIENCY = ("Very Poor", "Poor", "Average", "Good", "Very Good")
# (summary text, improvement id); the first 13 are common, then two rare ones.
REC_TYPES = (
    ("Cavity wall insulation", 6),
    ("Internal or external wall insulation", 7),
    ("Increase loft insulation to 270 mm", 5),
    ("Floor insulation (suspended floor)", 8),
    ("Heating controls (room thermostat and TRVs)", 12),
    ("Replace boiler with new condensing boiler", 20),
    ("High heat retention storage heaters", 18),
    ("Draught proofing", 9),
    ("Replace single glazed windows with low-E double glazed windows", 29),
    ("Increase hot water cylinder insulation", 1),
    ("Solar photovoltaic panels, 2.5 kWp", 34),
    ("Low energy lighting for all fixed outlets", 35),
    ("Solar water heating", 19),
    ("Wind turbine", 39),
    ("Fan assisted unit", 40),
)
N_COMMON = 13
LET_TYPES = ("General needs", "Supported housing")
TENANCIES = ("Secure", "Assured", "Starter", "Fixed term")
PREV_TENURES = ("Council tenant", "Housing association tenant", "Private renting",
                "Living with family", "Temporary accommodation")
REASONS = ("Overcrowding", "Homeless", "Relationship breakdown", "Medical grounds",
           "Moving for work")
ETHNICITIES = ("White", "Black", "Asian", "Mixed", "Other", "Refused")
TENANCY_LENGTHS = ("Less than 1 year", "1 to 2 years", "2 to 5 years", "5 years or more")
EMPLOYMENT = ("Full time", "Part time", "Unemployed", "Retired", "Student", "Other")
# Header variants of the lettings tab files, chosen per event type.
LETTINGS_MAIN = ("GOVREG", "YEAR", "LETTYPE", "TENANCY", "HHMEMBT", "BEDST",
                 "BED_MINUS_BEDSTANDARD", "PREVTEN_R", "REASON_R", "WEEKINC_T_Bands",
                 "WRENT_Bands", "WTSHORTFALLHB_Bands", "ETHNIC_Bands",
                 "TENANCYLENGTH_Bands", "econstat_imputed_R")
LETTINGS_VARIANTS = {
    "purchase": LETTINGS_MAIN,
    "view": tuple({"BED_MINUS_BEDSTANDARD": "BED_MINUS_BEDSTANDARD2",
                   "WTSHORTFALLHB_Bands": "WTSHORTFALL_Bands"}.get(c, c) for c in LETTINGS_MAIN),
    "click": tuple(c for c in LETTINGS_MAIN
                   if c not in ("econstat_imputed_R", "TENANCYLENGTH_Bands", "BED_MINUS_BEDSTANDARD")),
    "signup": ("SEX1", "YEAR", "AGE1") + tuple(reversed([c for c in LETTINGS_MAIN if c != "YEAR"])),
    "error": LETTINGS_MAIN,
}
DEFAULT_VARIANT = "purchase"


def pick(labels, idx: Column) -> Column:
    """labels[idx] for a 0-based integer column; NULL when out of range."""
    return F.get(F.array(*[F.lit(x) for x in labels]), idx.cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


def raw_certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row dimension: broadcasting it is size-safe.
    src = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    score = 20 + (ok * 13 + ck * 7) % 75
    potential = F.least(F.lit(100), score + (ok * 7) % 41)
    potential = F.when(ok % 43 == 0, score - 3).otherwise(potential)
    rating = (F.when(score >= 92, "A").when(score >= 81, "B").when(score >= 69, "C")
              .when(score >= 55, "D").when(score >= 39, "E").when(score >= 21, "F").otherwise("G"))
    status = F.col("o_orderstatus")
    tenure = (F.when(status == "F", "rental (social)")
              .when(status == "P", F.when(ok % 2 == 0, "SOCIAL RENTED").otherwise("Rented (Social)"))
              .otherwise(pick(("owner-occupied", "Rented (Social)", "rental (private)"), ok % 3)))
    both_missing = ck % 80 == 0
    return src.select(
        F.concat(F.lit("C"), _s(ok)).alias("certificate_number"),
        F.when(ck % 40 == 0, F.lit(None).cast("string")).when(ck % 40 == 1, F.lit(""))
         .otherwise(F.concat(F.lit("U"), _s(ck), F.lit("-"), _s(ok % 8))).alias("uprn"),
        F.when(both_missing, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("PC"), _s(ck % 97), F.lit(" "), _s(ok % 8), F.lit("AA"))).alias("postcode"),
        F.when(both_missing, F.lit(None).cast("string"))
         .otherwise(F.concat(_s(ck), F.lit(" TEST STREET"))).alias("address1"),
        F.concat(F.lit(fixed.AREA_CODE_PREFIX), F.lpad(_s(F.col("n_nationkey")), 6, "0")).alias("local_authority"),
        F.when(ok % 11 == 0, F.concat(F.col("n_name"), F.lit(" "))).otherwise(F.col("n_name"))
         .alias("local_authority_label"),
        tenure.alias("tenure"),
        pick(PROPERTY_TYPES, ck % 4).alias("property_type"),
        pick(BUILT_FORMS, ck % 5).alias("built_form"),
        pick(AGE_BANDS, ck % 13).alias("construction_age_band"),
        F.when(ok % 29 == 0, F.lit(None).cast("string")).otherwise(rating).alias("current_energy_rating"),
        _s(score).alias("current_energy_efficiency"),
        F.when(ok % 19 == 0, F.lit(None).cast("string")).otherwise(_s(potential))
         .alias("potential_energy_efficiency"),
        _s(30 + ck % 90).alias("total_floor_area"),
        F.when(ok % 8 == 7, F.lit(None).cast("string")).otherwise(pick(FUEL_LABELS, ok % 8)).alias("main_fuel"),
        _s((ok % 64) / 8.0).alias("co2_emissions_current"),
        _s(100 + ok % 300).alias("energy_consumption_current"),
        _s(300 + ck % 900).alias("heating_cost_current"),
        pick(EFFICIENCY, ok % 5).alias("walls_energy_eff"),
        pick(EFFICIENCY, (ok + 1) % 5).alias("roof_energy_eff"),
        pick(EFFICIENCY, (ok + 2) % 5).alias("windows_energy_eff"),
        F.when(ok % 8 < 3, "Y").otherwise("N").alias("mains_gas_flag"),
        F.when(ok % 37 == 0, F.lit(""))
         .otherwise(F.date_format(F.add_months(F.to_date("o_orderdate"), 240), "yyyy-MM-dd"))
         .alias("inspection_date"),
        F.when(ck % 23 == 0, "E12000002").otherwise(fixed.TARGET_REGION).alias("region"),
    )


def raw_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    bucket = pk % 100
    t = (F.when(bucket < 2, F.lit(N_COMMON)).when(bucket == 2, F.lit(None))
         .when(bucket < 5, F.lit(N_COMMON + 1)).otherwise((bucket - 5) % N_COMMON))
    lo = 25 * (1 + (pk * 7 + sk * 3) % 400)
    hi = lo + 25 * (sk % 30)
    fmt = lambda x: F.concat(F.lit("£"), F.format_number(x, 0))
    cost = (F.when(sk % 47 == 0, F.lit(None).cast("string"))
            .when(pk % 61 == 0, F.concat(fmt(lo), F.lit(" - "), fmt(hi), F.lit(" ("), fmt(lo + 25),
                                         F.lit(" typical)")))
            .when(hi == lo, fmt(lo))
            .otherwise(F.concat(fmt(lo), F.lit(" - "), fmt(hi))))
    return li.select(
        F.concat(F.lit("C"), _s(F.col("l_orderkey"))).alias("certificate_number"),
        _s(F.col("l_linenumber")).alias("improvement_item"),
        _s(pick([i for _, i in REC_TYPES], t)).alias("improvement_id"),
        pick([s for s, _ in REC_TYPES], t).alias("improvement_summary_text"),
        cost.alias("indicative_cost"),
    )


# Deprivation-index column names, as in the source CSV header.
IMD_CODE = "Local Authority District code (2019)"
IMD_NAME = "Local Authority District name (2019)"
IMD_SCORE = "Index of Multiple Deprivation (IMD) Score"
IMD_INCOME = "Income Score (rate)"
IMD_EMPLOY = "Employment Score (rate)"
IMD_HEALTH = "Health Deprivation and Disability Score"
IMD_LIVING = "Living Environment Score"


#: Areas in scope of the deprivation index: the 25 nations but for the five of region 4.
PRIORITY_AREAS = 20


def raw_deprivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per small area (customer); nations of region 4 get a non-area code."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    ck = F.col("c_custkey")
    prefix = F.when(F.col("n_regionkey") == 4, F.lit("E08")).otherwise(F.lit(fixed.AREA_CODE_PREFIX))
    return c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(prefix, F.lpad(_s(F.col("n_nationkey")), 6, "0")).alias(IMD_CODE),
        F.lower(F.col("n_name")).alias(IMD_NAME),
        ((ck * 37) % 4096 / 64.0).alias(IMD_SCORE),
        ((ck * 53) % 1024 / 2048.0).alias(IMD_INCOME),
        ((ck * 29) % 1024 / 4096.0).alias(IMD_EMPLOY),
        (((ck * 17) % 512 - 256) / 128.0).alias(IMD_HEALTH),
        ((ck * 11) % 4096 / 64.0).alias(IMD_LIVING),
    )


def _band(v: Column, width: int, top: int, eid: Column, missing: str) -> Column:
    lo = F.floor(v / width) * width + 1
    return (F.when(eid % 29 == 0, F.lit(missing))
            .when(eid % 37 == 0, F.lit(""))
            .when(v >= top, F.concat(F.lit("More than "), F.format_number(F.lit(top), 0)))
            .when(v < width, F.concat(F.lit("Less than "), _s(F.lit(width))))
            .when(eid % 41 == 0, _s(F.floor(v)))
            .otherwise(F.concat(F.format_number(lo, 0), F.lit(" to "), F.format_number(lo + width - 1, 0))))


def raw_lettings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lettings columns (union of every header variant) plus ``variant``."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    eid, uid, v = F.col("event_id"), F.col("user_id"), F.col("value")
    year = 2007 + eid % 16
    region = (F.when((F.col("event_type") == "error") | (uid % 10 == 0), F.lit("E12000002"))
              .when(year < 2012, F.lit("7")).otherwise(F.lit(fixed.TARGET_REGION)))
    region = F.when(eid % 17 == 0, F.concat(region, F.lit(" "))).otherwise(region)
    bedst = _s(1 + uid % 4)
    return e.select(
        F.col("event_type").alias("variant"),
        region.alias("GOVREG"),
        _s(year).alias("YEAR"),
        pick(LET_TYPES, eid % 2).alias("LETTYPE"),
        pick(TENANCIES, uid % 4).alias("TENANCY"),
        F.when(eid % 31 == 0, F.lit("")).otherwise(_s(1 + uid % 6)).alias("HHMEMBT"),
        F.when(eid % 13 == 0, F.concat(bedst, F.lit(".0"))).otherwise(bedst).alias("BEDST"),
        F.when(eid % 23 == 0, F.lit(" ")).otherwise(_s(eid % 5 - 2)).alias("BED_MINUS_BEDSTANDARD"),
        pick(PREV_TENURES, uid % 5).alias("PREVTEN_R"),
        pick(REASONS, eid % 5).alias("REASON_R"),
        _band(v * 3, 50, 1000, eid, "Missing").alias("WEEKINC_T_Bands"),
        _band(v * 1.5, 25, 500, eid + 7, "R").alias("WRENT_Bands"),
        _band(v / 2, 10, 100, eid + 11, "Refused").alias("WTSHORTFALLHB_Bands"),
        pick(ETHNICITIES, uid % 6).alias("ETHNIC_Bands"),
        pick(TENANCY_LENGTHS, eid % 4).alias("TENANCYLENGTH_Bands"),
        pick(EMPLOYMENT, (eid + uid) % 6).alias("econstat_imputed_R"),
        F.lit("M").alias("SEX1"),
        _s(18 + uid % 60).alias("AGE1"),
    )


def imd_schema():
    """Declared schema of the deprivation-index CSV (S6: no inference pass)."""
    from pyspark.sql import types as T
    return T.StructType([T.StructField(IMD_CODE, T.StringType()), T.StructField(IMD_NAME, T.StringType())]
                        + [T.StructField(c, T.DoubleType())
                           for c in (IMD_SCORE, IMD_INCOME, IMD_EMPLOY, IMD_HEALTH, IMD_LIVING)])
