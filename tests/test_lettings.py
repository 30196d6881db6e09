"""Lettings ingest from drifting tab files (the reference's lettings cases)."""

import uuid

from hearth.plans.lettings import lettings_silver_from_files
from hearth.session import scratch_path
from hearth.sources.readers import list_files
from hearth.sources.sinks import write_tab_files

MAIN = ["GOVREG", "YEAR", "LETTYPE", "TENANCY", "HHMEMBT", "BEDST", "BED_MINUS_BEDSTANDARD", "PREVTEN_R",
        "REASON_R", "WEEKINC_T_Bands", "WRENT_Bands", "WTSHORTFALLHB_Bands", "ETHNIC_Bands",
        "TENANCYLENGTH_Bands", "econstat_imputed_R"]


def write(spark, root, header, rows):
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in header))
    write_tab_files(df.coalesce(1), f"{root}/{uuid.uuid4().hex[:6]}")


def row(header, **kw):
    base = dict(GOVREG="E12000007", YEAR="2020", LETTYPE="General needs", TENANCY="Secure", HHMEMBT="3",
                BEDST="2", BED_MINUS_BEDSTANDARD="-1", BED_MINUS_BEDSTANDARD2="-1", PREVTEN_R="x", REASON_R="y",
                WEEKINC_T_Bands="151 to 190", WRENT_Bands="More than 500", WTSHORTFALLHB_Bands="Missing",
                WTSHORTFALL_Bands="Less than 50", ETHNIC_Bands="e", TENANCYLENGTH_Bands="t", econstat_imputed_R="u")
    base.update(kw)
    return tuple(base[c] for c in header)


def test_drifting_files(spark):
    root = scratch_path(spark, f"test-lettings-{uuid.uuid4().hex[:8]}")
    alt = [{"BED_MINUS_BEDSTANDARD": "BED_MINUS_BEDSTANDARD2", "WTSHORTFALLHB_Bands": "WTSHORTFALL_Bands"}.get(c, c)
           for c in MAIN]
    old = [c for c in MAIN if c not in ("econstat_imputed_R", "TENANCYLENGTH_Bands", "BED_MINUS_BEDSTANDARD")]
    write(spark, root, MAIN, [row(MAIN), row(MAIN, GOVREG="E12000002")])
    write(spark, root, alt, [row(alt, YEAR="2015")])
    write(spark, root, old, [row(old, GOVREG="7", YEAR="2010", HHMEMBT="")])
    write(spark, root, MAIN, [row(MAIN, GOVREG="E12000002")])            # file with no in-scope rows
    out = lettings_silver_from_files(spark, list_files(spark, root, ".csv"))
    rows = {r["year"]: r for r in out.collect()}
    assert sorted(rows) == [2010, 2015, 2020]
    assert rows[2020]["weekly_income_est"] == 170.5 and rows[2020]["weekly_rent_est"] == 500.0
    assert rows[2020]["rent_shortfall_est"] is None and rows[2020]["overcrowded"] is True
    assert rows[2015]["rent_shortfall_band"] == "Less than 50" and rows[2015]["bedrooms_vs_need"] == -1
    assert rows[2010]["bedrooms_vs_need"] is None and rows[2010]["overcrowded"] is False
    assert rows[2010]["household_size"] is None and rows[2010]["employment_status"] is None
    assert abs(rows[2020]["rent_to_income_pct"] - 500.0 / 170.5 * 100) < 1e-9
    assert set(r["region_code"] for r in rows.values()) == {"E12000007"}
