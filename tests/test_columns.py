"""Band and cost parsing, categories and flags (the reference's helper cases, as column jobs)."""

import pytest
from pyspark.sql import functions as F

from hearth.functions import columns as C


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text, expected", [
    ("151 to 190", 170.5), ("More than 500", 500.0), ("Less than 50", 25.0), ("300", 300.0),
    ("1,000 to 2,000", 1500.0), ("Missing", None), ("Refused", None), ("", None), (None, None),
    ("MISSING", None), ("R", None), ("N/A", None), ("Yes", None), ("  151 to 190\t", 170.5),
    ("more than 1,000", 1000.0), ("abc", None), ("£150 to £199.99", None),
])
def test_band_midpoint(spark, text, expected):
    assert one(spark, C.band_midpoint, text) == expected


@pytest.mark.parametrize("text, low, mid, high", [
    ("£800 - £1,200", 800.0, 1000.0, 1200.0),
    ("£500", 500.0, 500.0, 500.0),
    (None, None, None, None),
    ("£8,000 - £25,000", 8000.0, 16500.0, 25000.0),
    ("£1 - £2 (£3 typical)", 1.0, None, None),   # three numbers: helper rule
    ("no cost", None, None, None),
    ("£199.99", 199.0, 149.0, 99.0),             # the number pattern splits decimals (199 and 99)
])
def test_cost_bounds(spark, text, low, mid, high):
    r = spark.createDataFrame([(text,)], "v string").select(C.cost_bounds("v").alias("c")).first()["c"]
    assert (r["low"], r["mid"], r["high"]) == (low, mid, high)


@pytest.mark.parametrize("text, cat", [
    ("Cavity wall insulation", "Insulation"), ("Replace boiler with new condensing boiler", "Heating system"),
    ("Heating controls (room thermostat and TRVs)", "Heating controls"), ("Draught proofing", "Glazing & draughts"),
    ("Increase hot water cylinder insulation", "Hot water cylinder"), ("Solar water heating", "Renewables"),
    ("Low energy lighting for all fixed outlets", "Lighting"), ("Fan assisted unit", "Other"), (None, "Other"),
    ("Flat roof insulation and solar panels", "Insulation"),   # first match wins
])
def test_category(spark, text, cat):
    assert one(spark, C.category, text) == cat


@pytest.mark.parametrize("fuel, cat", [
    ("mains gas (not community)", "gas_individual"), ("mains gas (community)", "gas_community"),
    ("electricity (not community)", "electric_individual"), ("electricity (community)", "electric_community"),
    ("oil", "other"), (None, None), ("Gas: mains gas", "gas_individual"),
])
def test_fuel_category(spark, fuel, cat):
    assert one(spark, C.fuel_category, fuel) == cat


@pytest.mark.parametrize("rating, flag", [("A", False), ("C", False), ("D", True), ("G", True), (None, False)])
def test_below_c(spark, rating, flag):
    assert one(spark, C.below_c_flag, rating) is flag


@pytest.mark.parametrize("raw, val", [("", None), (" 3 ", 3), ("3.0", 3), ("x", None), (None, None)])
def test_safe_int(spark, raw, val):
    assert one(spark, C.safe_int, raw) == val


def test_work_tier_and_money(spark):
    df = spark.createDataFrame([(1000.0,), (1000.5,), (None,)], "m double")
    tiers = [r[0] for r in df.select(C.work_tier("m")).collect()]
    assert tiers == ["Quick win", "Major works", "Major works"]
    r = spark.createDataFrame([(1234.4, 1000.0, 2500.6)], "m double, l double, h double")
    assert r.select(C.money_range("m", "l", "h")).first()[0] == "£1,234 (£1,000–£2,501)"
    r2 = spark.createDataFrame([(None, 1.0, 2.0)], "m double, l double, h double")
    assert r2.select(C.money_range("m", "l", "h")).first()[0] == ""


def test_age_group(spark):
    df = spark.createDataFrame([("England and Wales: 1900-1929",), ("NO DATA!",), (None,)], "b string")
    assert [r[0] for r in df.select(C.age_group("b")).collect()] == ["Pre-1919", "Unknown", "Unknown"]
