"""Marts in SQL: straight over raw CSV views (S7), and over bucketed catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from ..sources import bronze
from . import layers
from .ingest import bronze_csv, bronze_certificates_csv
from .layers import _fingerprint
from .silver import recommendations

#: Views over the raw files, with declared columns; their paths are session variables.
RAW_VIEWS = {
    "raw_certificates": ("certificates_path", """
        certificate_number STRING, uprn STRING, postcode STRING, address1 STRING, local_authority STRING, local_authority_label STRING,
        tenure STRING, property_type STRING, built_form STRING, construction_age_band STRING, current_energy_rating STRING,
        current_energy_efficiency STRING, potential_energy_efficiency STRING, total_floor_area STRING, main_fuel STRING,
        co2_emissions_current STRING, energy_consumption_current STRING, heating_cost_current STRING, walls_energy_eff STRING,
        roof_energy_eff STRING, windows_energy_eff STRING, mains_gas_flag STRING, inspection_date STRING, region STRING"""),
    "raw_recommendations": ("recommendations_path", """
        certificate_number STRING, improvement_item STRING, improvement_id STRING, improvement_summary_text STRING, indicative_cost STRING"""),
}
#: Staging views: types, scope and the latest certificate per property; cost text to its midpoint.
STAGING = {
    "stg_certificates": """
        SELECT certificate_id, borough FROM (
          SELECT trim(certificate_number) AS certificate_id, trim(local_authority_label) AS borough,
                 row_number() OVER (
                   PARTITION BY CASE WHEN trim(uprn) <> '' THEN trim(uprn)
                                     WHEN coalesce(trim(postcode), '') = '' AND coalesce(trim(address1), '') = '' THEN trim(certificate_number)
                                     ELSE concat_ws('|', trim(postcode), trim(address1)) END
                   ORDER BY try_to_date(inspection_date, 'yyyy-MM-dd') DESC NULLS LAST, trim(certificate_number) DESC) AS newest
          FROM raw_certificates
          WHERE upper(trim(tenure)) IN ('RENTAL (SOCIAL)', 'SOCIAL RENTED', 'RENTED (SOCIAL)') AND trim(region) = 'E12000007'
            AND trim(current_energy_rating) IS NOT NULL)
        WHERE newest = 1""",
    "stg_recommendations": """
        SELECT certificate_id, CASE size(n) WHEN 1 THEN n[0] WHEN 2 THEN (n[0] + n[1]) / 2 END AS cost_mid FROM (
          SELECT certificate_number AS certificate_id,
                 transform(regexp_extract_all(coalesce(indicative_cost, ''), '[0-9,]+', 0), x -> try_cast(replace(x, ',', '') AS DOUBLE)) AS n
          FROM raw_recommendations)""",
}
#: The mart itself, over either pair of relations.
RETROFIT_COSTS = """
    SELECT {hint} c.borough, count(r.certificate_id) AS total_recommendations, round(avg(r.cost_mid), 0) AS avg_cost_per_recommendation,
           round(sum(r.cost_mid) / 1000000, 2) AS total_indicative_cost_m
    FROM {recommendations} r JOIN {certificates} c ON r.certificate_id = c.certificate_id
    WHERE c.borough IS NOT NULL
    GROUP BY c.borough"""


def declare_raw_views(spark: SparkSession, paths: dict[str, str]) -> None:
    """Set the path variables, and make the raw and staging views over the files there."""
    for view, (variable, columns) in RAW_VIEWS.items():
        spark.sql(f"DECLARE OR REPLACE VARIABLE {variable} STRING")
        spark.sql(f"SET VARIABLE {variable} = :path", args={"path": paths[view]})
        spark.sql("DECLARE OR REPLACE VARIABLE make_view STRING")
        spark.sql(f"""SET VARIABLE make_view = concat(
            'CREATE OR REPLACE TEMPORARY VIEW {view} ({columns}) USING csv OPTIONS (path "', {variable}, '", header "true", enforceSchema "false")')""")
        spark.sql("EXECUTE IMMEDIATE make_view")
    for view, query in STAGING.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS {query}")


def retrofit_costs_from_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retrofit-cost mart from the raw CSV views alone."""
    declare_raw_views(spark, {"raw_certificates": bronze_certificates_csv(spark, sf_dir),
                              "raw_recommendations": bronze_csv(spark, sf_dir, "recommendations", bronze.raw_recommendations(spark, sf_dir))})
    return spark.sql(RETROFIT_COSTS.format(hint="", recommendations="stg_recommendations", certificates="stg_certificates"))


#: Buckets of the catalog tables: both have as many, so that their join moves no row. A cluster sets more.
BUCKETS_KEY, BUCKETS = "spark.hearth.buckets", 16


def bucketed_table(spark: SparkSession, name: str, root: str, build, key: str) -> str:
    """The catalog table ``name``, bucketed and sorted by ``key``, one file a bucket; saved once a session and input."""
    if not spark.catalog.tableExists(name):
        n = int(spark.conf.get(BUCKETS_KEY, str(BUCKETS)))
        build().repartition(n, key).write.mode("ignore").format("parquet").bucketBy(n, key).sortBy(key).option("path", root).saveAsTable(name)
    return name


def catalog_tables(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Certificates and recommendations as bucketed tables of the session's catalog (K4)."""
    mark = f"{_fingerprint(spark, sf_dir, 'catalog')}_{spark.sparkContext.applicationId}".replace("-", "_")
    builds = {"certificates": lambda: layers.certificates(spark, sf_dir).select("certificate_id", "borough", "epc_rating", "epc_score"),
              "recommendations": lambda: recommendations(spark, sf_dir).select("certificate_id", "improvement_type", "cost_low", "cost_mid", "cost_high")}
    return {k: bucketed_table(spark, f"hearth_{k}_{mark}", scratch_path(spark, f"catalog/{mark}/{k}"), build, "certificate_id")
            for k, build in builds.items()}


def retrofit_costs_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart over catalog tables: both sides are bucketed by certificate, so the join needs no exchange.

    The hint keeps the planner from sending one side to all executors where it is small, as in tests.
    """
    return spark.sql(RETROFIT_COSTS.format(hint="/*+ MERGE(r, c) */", **catalog_tables(spark, sf_dir)))
