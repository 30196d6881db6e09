"""Lettings: drifting tab files -> silver, affordability trend, sanity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..session import scratch_path
from ..sources import bronze, snapshots
from ..sources.readers import (column_availability, column_or_null, file_catalogue, file_path, first_present, header_catalogue, list_files,
                               read_drifting, require_rows, rows_by_file)
from ..sources.sinks import write_tab_files

# Target column -> source header names (first present wins) and type.
LETTINGS_COLUMNS = (
    ("let_type", ("LETTYPE",), "string"),
    ("tenancy_type", ("TENANCY",), "string"),
    ("household_size", ("HHMEMBT",), "int"),
    ("bedroom_standard", ("BEDST",), "int"),
    ("bedrooms_vs_need", ("BED_MINUS_BEDSTANDARD", "BED_MINUS_BEDSTANDARD2"), "int"),
    ("previous_tenure", ("PREVTEN_R",), "string"),
    ("reason_for_letting", ("REASON_R",), "string"),
    ("weekly_income_band", ("WEEKINC_T_Bands",), "string"),
    ("weekly_rent_band", ("WRENT_Bands",), "string"),
    ("rent_shortfall_band", ("WTSHORTFALLHB_Bands", "WTSHORTFALL_Bands"), "string"),
    ("ethnicity", ("ETHNIC_Bands",), "string"),
    ("tenancy_length_band", ("TENANCYLENGTH_Bands",), "string"),
    ("employment_status", ("econstat_imputed_R",), "string"),
)


def bronze_dir(spark: SparkSession, sf_dir: str) -> str:
    from .layers import _fingerprint
    return scratch_path(spark, f"bronze/{_fingerprint(spark, sf_dir, 'lettings-tab', ('events',))}/lettings")


def write_lettings_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Write the lettings as tab files, one file per header layout and year, once per input snapshot.

    This is the binding's stand-in for the shipped raw files: each event type
    gets its own header layout (renamed, missing, extra and reordered columns).
    A writer works in a folder of its own; the first to finish publishes it in the manifest.
    """
    return snapshots.folder(spark, bronze_dir(spark, sf_dir), lambda out: _write_layouts(spark, sf_dir, out))


def _write_layouts(spark: SparkSession, sf_dir: str, out: str) -> None:
    raw = bronze.raw_lettings(spark, sf_dir)
    renamed = {"BED_MINUS_BEDSTANDARD2": "BED_MINUS_BEDSTANDARD",
               "WTSHORTFALL_Bands": "WTSHORTFALLHB_Bands"}
    for variant, header in bronze.LETTINGS_VARIANTS.items():
        cols = [F.col(renamed.get(h, h)).alias(h) for h in header]
        own = F.col("variant") == variant
        if variant == bronze.DEFAULT_VARIANT:   # also holds event types that have no layout of their own
            own = F.col("variant").isNull() | ~F.col("variant").isin(*(set(bronze.LETTINGS_VARIANTS) - {variant}))
        write_tab_files(raw.filter(own).select(*cols, F.col("YEAR").alias("of_year")), f"{out}/{variant}", "of_year")


def standardise_lettings(df: DataFrame, present: set[str], *extra: Column) -> DataFrame:
    """One header layout -> the standard lettings columns and ``extra``, London rows only."""
    gov = F.trim(F.col("GOVREG"))
    cols = [column_or_null(present, "YEAR", "int", C.safe_int).alias("year"),
            gov.alias("region_code_raw")]
    for target, names, dtype in LETTINGS_COLUMNS:
        name = first_present(present, *names)
        conv = C.safe_int if dtype == "int" else F.trim
        cols.append(column_or_null(present, name, dtype, conv).alias(target))
    cols += extra
    return df.filter(gov.isin(*fixed.LETTINGS_REGION_CODES)).select(*cols)


def lettings_silver_from_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    combined = read_drifting(spark, paths, "\t", standardise_lettings)
    est_income = C.band_midpoint("weekly_income_band")
    est_rent = C.band_midpoint("weekly_rent_band")
    return (
        combined
        .withColumn("region_code", F.lit(fixed.TARGET_REGION))
        .drop("region_code_raw")
        .withColumn("weekly_income_est", est_income)
        .withColumn("weekly_rent_est", est_rent)
        .withColumn("rent_shortfall_est", C.band_midpoint("rent_shortfall_band"))
        .withColumn("rent_to_income_pct", C.guarded_pct("weekly_rent_est", "weekly_income_est"))
        .withColumn("overcrowded", C.overcrowded_flag("bedrooms_vs_need"))
    )


def lettings_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = write_lettings_bronze(spark, sf_dir)
    return require_rows(lettings_silver_from_files(spark, list_files(spark, root, ".csv")), "lettings")


def affordability_trend(silver: DataFrame) -> DataFrame:
    """Per-year rent/income/affordability measures (A3)."""
    return (
        silver.filter(F.col("weekly_rent_est").isNotNull() & F.col("weekly_income_est").isNotNull())
        .groupBy("year")
        .agg(
            F.count(F.lit(1)).alias("lettings"),
            F.round(F.avg("weekly_rent_est"), 2).alias("avg_weekly_rent"),
            F.round(F.avg("weekly_income_est"), 2).alias("avg_weekly_income"),
            F.round(F.avg("rent_to_income_pct"), 1).alias("avg_rent_to_income_pct"),
            C.pct(F.col("rent_to_income_pct") > 50).alias("pct_spending_over_50pct_on_rent"),
            C.pct(F.col("overcrowded")).alias("pct_overcrowded"),
        )
    )


def lettings_sanity(silver: DataFrame) -> DataFrame:
    """Overall averages (A31) plus rows with rent data per year, in one pass."""
    return silver.agg(
        F.count(F.lit(1)).alias("lettings"),
        F.count("weekly_rent_est").alias("with_rent"),
        F.round(F.avg("weekly_rent_est"), 2).alias("avg_weekly_rent"),
        F.round(F.avg("weekly_income_est"), 2).alias("avg_weekly_income"),
        F.round(F.avg("rent_to_income_pct"), 1).alias("avg_rent_to_income_pct"),
    )


def _shipped(file: str | Column) -> Column:
    """A file's name as shipped, layout/year, out of its path."""
    return F.regexp_replace(F.regexp_extract(file, r"/([^/]+/of_year=[^/]+)/[^/]+$", 1), "of_year=", "")


def _with_files(spark: SparkSession, sf_dir: str) -> tuple[list[str], DataFrame]:
    """The shipped files, and the in-scope rows with the ``file`` that each comes from."""
    files = list_files(spark, write_lettings_bronze(spark, sf_dir), ".csv")
    return files, read_drifting(spark, files, "\t", lambda df, present: standardise_lettings(df, present, file_path().alias("file")))


def rows_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-scope rows per source folder and in total (A32) from one scan, via the file name."""
    rows = _with_files(spark, sf_dir)[1].withColumn("source", F.regexp_extract("file", r"/([^/]+)/of_year=[^/]+/[^/]+$", 1))
    return rows.rollup("source").agg(F.count(F.lit(1)).alias("rows_in_scope")).withColumn(
        "source", F.coalesce("source", F.lit("total")))


def rows_in_scope_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-scope rows of every shipped file, those without any included, and the total."""
    files, rows = _with_files(spark, sf_dir)
    counted = rows_by_file(file_catalogue(spark, files), rows).withColumn("file", _shipped("file"))
    return counted.rollup("file").agg(F.sum("rows").alias("rows_in_scope")).withColumn("file", F.coalesce("file", F.lit("total")))


def headers_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header catalogue: every shipped file's columns with their positions."""
    files = list_files(spark, write_lettings_bronze(spark, sf_dir), ".csv")
    return header_catalogue(spark, files, "\t").select(_shipped("file").alias("file"), "position", "column_name")


def columns_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-by-folder availability matrix."""
    files = list_files(spark, write_lettings_bronze(spark, sf_dir), ".csv")
    return column_availability(header_catalogue(spark, files, "\t"), F.split_part(_shipped("file"), F.lit("/"), F.lit(1)),
                               sorted(bronze.LETTINGS_VARIANTS))
