"""Raw-file ingest and export paths.

The reference reads its raw certificates from CSV files and writes gold
tables as Parquet and small CSV exports; these plans run that path end to
end on files Spark derives from the driver's tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources import bronze, snapshots
from ..sources.readers import read_csv_named, read_csv_strings, read_csv_typed, validate_columns
from ..sources.sinks import materialise, write_small_csv, write_verified
from . import gold, layers, retrofit
from .layers import _fingerprint
from .silver import CERT_REQUIRED, REC_REQUIRED, certificates_silver_from_raw, recommendations_from_raw


def bronze_csv(spark: SparkSession, sf_dir: str, name: str, raw: DataFrame) -> str:
    """``raw`` as CSV files with a header, written once per input snapshot and published through a manifest."""
    root = scratch_path(spark, f"bronze/{_fingerprint(spark, sf_dir, 'csv')}/{name}")
    return snapshots.folder(spark, root, lambda path: raw.write.option("header", True).csv(path))


def bronze_certificates_csv(spark: SparkSession, sf_dir: str) -> str:
    return bronze_csv(spark, sf_dir, "certificates", bronze.raw_certificates(spark, sf_dir))


def recommendations_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV scan (all strings) -> required-column check -> typed recommendations."""
    path = bronze_csv(spark, sf_dir, "recommendations", bronze.raw_recommendations(spark, sf_dir))
    raw = read_csv_strings(spark, path)
    validate_columns(raw.columns, REC_REQUIRED, "recommendations bronze")
    return recommendations_from_raw(raw)


def deprivation_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide deprivation CSV, its columns bound by name and typed as declared (S6), to one row per area."""
    raw = bronze.raw_deprivation(spark, sf_dir)
    wide = raw.select(F.lit("E01").alias("LSOA code (2011)"), *reversed(raw.columns), F.lit("10").alias("Total population"))
    path = bronze_csv(spark, sf_dir, "deprivation", wide)
    return gold.area_deprivation(read_csv_named(spark, path, bronze.imd_schema(), name="deprivation"))


def certificates_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV scan (all strings) -> required-column check -> silver transform."""
    raw = read_csv_strings(spark, bronze_certificates_csv(spark, sf_dir), ",", glob_filter="part-*.csv")
    validate_columns(raw.columns, CERT_REQUIRED, "certificates bronze")
    return certificates_silver_from_raw(raw)


COSTS_SCHEMA = T.StructType([
    T.StructField("borough", T.StringType()),
    T.StructField("total_recommendations", T.LongType()),
    T.StructField("avg_cost_per_recommendation", T.DoubleType()),
    T.StructField("total_indicative_cost_m", T.DoubleType()),
])


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold table -> verified Parquet (K2, K5) + one-file CSV export (K3) -> typed CSV read."""
    costs = retrofit.retrofit_costs(layers.retrofit_rollup(spark, sf_dir))
    root = scratch_path(spark, f"gold/export-{uuid.uuid4().hex}")   # an earlier call's result still reads its own
    write_verified(costs, f"{root}/retrofit_costs")
    write_small_csv(spark.read.parquet(f"{root}/retrofit_costs"), f"{root}/retrofit_costs_csv")
    return read_csv_typed(spark, f"{root}/retrofit_costs_csv", COSTS_SCHEMA)


def retrofit_costs_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retrofit-cost mart through the SQL API over a registered view."""
    materialise(layers.retrofit_base(spark, sf_dir), "retrofit_base")
    return spark.sql("""
        SELECT borough,
               count(certificate_id)               AS total_recommendations,
               round(avg(cost_mid), 0)             AS avg_cost_per_recommendation,
               round(sum(cost_mid) / 1000000, 2)   AS total_indicative_cost_m
        FROM retrofit_base
        WHERE borough IS NOT NULL
        GROUP BY borough""")
