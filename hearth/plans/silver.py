"""Silver tables: certificates (typed, in scope, latest per property) and lettings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..operators.dedup import latest_per_key, property_key
from ..sources import bronze

CERT_REQUIRED = {
    "certificate_number", "local_authority_label", "tenure", "region", "current_energy_rating",
    "current_energy_efficiency", "uprn", "postcode", "address1", "inspection_date",
}

_TRIMMED = {
    "certificate_number": "certificate_id", "uprn": "uprn", "postcode": "postcode",
    "address1": "address1", "local_authority": "local_authority_code",
    "local_authority_label": "borough", "tenure": "tenure", "property_type": "property_type",
    "built_form": "built_form", "construction_age_band": "construction_age_band",
    "current_energy_rating": "epc_rating",
}
_NUMERIC = {
    "current_energy_efficiency": "epc_score", "total_floor_area": "floor_area_m2",
    "co2_emissions_current": "co2_emissions", "energy_consumption_current": "energy_consumption",
    "heating_cost_current": "heating_cost", "potential_energy_efficiency": "epc_potential",
}
_TRIMMED_TAIL = {
    "main_fuel": "main_fuel", "walls_energy_eff": "walls_energy_eff",
    "roof_energy_eff": "roof_energy_eff", "windows_energy_eff": "windows_energy_eff",
    "mains_gas_flag": "mains_gas_flag",
}


def in_scope_certificates(raw: DataFrame) -> DataFrame:
    """Trim + rename + cast (P1), then tenure and region (P5, P6); rows without a rating stay."""
    present = set(raw.columns)
    cols = [F.trim(F.col(s)).alias(t) for s, t in _TRIMMED.items()]
    cols += [C.to_double(s).alias(t) for s, t in _NUMERIC.items() if s in present]
    cols += [F.trim(F.col(s)).alias(t) for s, t in _TRIMMED_TAIL.items()]
    cols += [C.parse_date("inspection_date").alias("inspection_date"),
             F.trim(F.col("region")).alias("region_code")]
    return (
        raw.select(*cols)
        .filter(C.tenure_in_scope("tenure"))
        .filter(F.col("region_code") == fixed.TARGET_REGION)
    )


def project_certificates(raw: DataFrame) -> DataFrame:
    """In-scope certificates that have a rating."""
    return in_scope_certificates(raw).filter(F.col("epc_rating").isNotNull())


def certificates_silver_from_raw(raw: DataFrame) -> DataFrame:
    """Bronze certificates -> silver (latest certificate per property + derived flags)."""
    projected = project_certificates(raw)
    latest = latest_per_key(projected, property_key(), ["inspection_date", "certificate_id"])
    return (
        latest
        .withColumn("below_epc_c", C.below_c_flag("epc_rating"))
        .withColumn("inspection_year", F.year("inspection_date"))
        .withColumn("fuel_category", C.fuel_category("main_fuel"))
    )


def certificates_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return certificates_silver_from_raw(bronze.raw_certificates(spark, sf_dir))


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed recommendations of the driver's tables."""
    return recommendations_from_raw(bronze.raw_recommendations(spark, sf_dir))


REC_REQUIRED = {"certificate_number", "improvement_item", "improvement_id", "improvement_summary_text", "indicative_cost"}


def recommendations_from_raw(raw: DataFrame, *keep: str) -> DataFrame:
    """Bronze recommendations -> typed (no scope filter), cost text parsed once into low/mid/high; columns ``keep`` stay."""
    cost = C.cost_bounds("indicative_cost")
    return raw.select(
        F.col("certificate_number").alias("certificate_id"),
        C.safe_int("improvement_item").alias("priority"),
        C.safe_int("improvement_id").alias("improvement_id"),
        F.col("improvement_summary_text").alias("improvement_type"),
        F.col("indicative_cost"),
        cost["low"].alias("cost_low"),
        cost["mid"].alias("cost_mid"),
        cost["high"].alias("cost_high"),
        *keep,
    )


#: What a recommendation takes from its certificate.
JOINED_COLUMNS = ("borough", "epc_rating", "epc_score", "epc_potential", "construction_age_band", "property_type")


def joined_recommendations(spark: SparkSession, sf_dir: str, silver: DataFrame | None = None) -> DataFrame:
    """Recommendations ⋈ in-scope certificates (J1), NULL boroughs dropped (trap 5).

    Both sides grow with the data, so this is a shuffle join on the
    certificate id; AQE may switch to broadcast when the silver side is small
    at run time, and splits skewed partitions. Hash tables of the certificates
    (a row per property) spare a sort of the wide recommendations, which spills.
    Costs are parsed behind the join, so that the shuffle carries their text
    alone and rows that meet no certificate are not parsed.
    """
    certs = (silver if silver is not None else certificates_silver(spark, sf_dir)).select(
        F.col("certificate_id").alias("certificate_number"), *JOINED_COLUMNS,
    ).filter(F.col("borough").isNotNull())
    raw = bronze.raw_recommendations(spark, sf_dir)
    return recommendations_from_raw(raw.join(certs.hint("shuffle_hash"), "certificate_number", "inner"), *JOINED_COLUMNS)
