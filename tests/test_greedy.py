"""Greedy cheapest cover against a plain-Python reimplementation on real rows."""

import math

import pytest
from pyspark.sql import functions as F

from hearth.functions import fixed
from hearth.plans import layers, reach
from tests.conftest import SF_SMALL


def brute_force(rows, lookups):
    by_age, by_type, glob = lookups
    certs = {}
    for r in rows:
        certs.setdefault(r["certificate_id"], []).append(r)
    out = {}
    for cid, recs in certs.items():
        items = []
        for r in recs:
            est = by_age.get((r["improvement_type"], r["age_group"]), by_type.get(r["improvement_type"], glob))
            cpp = r["cost_mid"] / est if (est is not None and est > 0 and r["cost_mid"] is not None) else math.inf
            key = (cpp, r["improvement_type"] is None, r["improvement_type"] or "",
                   r["priority"] is None, r["priority"] or 0,
                   r["cost_low"] is None, r["cost_low"] or 0, r["cost_high"] is None, r["cost_high"] or 0)
            items.append((key, round(est * 100), r))
        items.sort(key=lambda t: t[0])
        gap = (fixed.TARGET_SCORE - recs[0]["epc_score"]) * 100
        cum, cover = 0, None
        for i, (_, e, _) in enumerate(items):
            cum += e
            if cum >= gap:
                cover = i
                break
        if cover is None:
            continue
        sel = [t[2] for t in items[:cover + 1]]
        out[cid] = (sum(r["cost_mid"] or 0 for r in sel), sum(1 for r in sel if r["improvement_type"] is not None))
    return out


def test_greedy_matches_brute_force(spark):
    silver = layers.certificates(spark, SF_SMALL)
    recs = reach.scored_recs(spark, SF_SMALL)
    long = reach.uplift_attribution(recs, silver, min_freq=20, min_rows=5).checkpoint()
    by_age_df, by_type_df, glob_df = reach.uplift_lookup(long)
    by_age = {(r[0], r[1]): r[2] for r in by_age_df.collect()}
    by_type = {r[0]: r[1] for r in by_type_df.collect()}
    glob = glob_df.first()["u_global"]
    cand = recs.filter((F.col("epc_score") < fixed.TARGET_SCORE) & (F.col("epc_potential") >= fixed.TARGET_SCORE))
    rows = cand.collect()
    assert 0 < len(rows) < 5000
    expected = brute_force(rows, (by_age, by_type, glob))
    got = {r["certificate_id"]: (r["greedy_cost_mid"], r["n_recs_needed"])
           for r in reach.greedy_cover(reach.greedy_results(reach.greedy_rows(recs, long))).collect()}
    assert set(got) == set(expected)
    for k, (cost, n) in expected.items():
        assert got[k][0] == pytest.approx(cost) and got[k][1] == n


def test_skew_safe_cover_matches_brute_force_on_a_hot_certificate(spark):
    """One certificate holding most rows is split over partitions; the selection is unchanged."""
    import random
    rnd = random.Random(5)
    types = [f"type {i}" for i in range(12)]
    rows = []
    for i in range(3000):   # the hot certificate, including exact duplicate rows
        t = rnd.choice(types)
        lo = float(rnd.randint(1, 40) * 25)
        rows.append(("HOT", t, "Pre-1919", rnd.randint(1, 9), lo, lo + 50.0, lo + 100.0, 20.0, 80.0))
    for c in range(40):
        score = float(rnd.randint(40, 68))   # a certificate's own, the same on all of its rows
        for i in range(rnd.randint(1, 6)):
            lo = float(rnd.randint(1, 40) * 25)
            rows.append((f"C{c}", rnd.choice(types + [None]), "2007+", i + 1, lo, lo + 50.0, lo + 100.0,
                         score, 75.0))
    recs = spark.createDataFrame(rows, "certificate_id string, improvement_type string, age_group string, "
                                       "priority int, cost_low double, cost_mid double, cost_high double, "
                                       "epc_score double, epc_potential double")
    long = spark.createDataFrame(
        [(t, g, round(0.01 + (i % 5) * 0.37, 2), round(0.5 + (i % 3) * 0.25, 2), 100)
         for i, t in enumerate(types[:10]) for g in ("Pre-1919", "2007+")],
        "improvement_type string, age_group string, avg_pts double, overall_avg_pts double, n_present long")
    skew = reach.greedy_rows(recs, long, partitions=16)
    spans = skew.filter(F.col("certificate_id") == "HOT").select("_p").distinct().count()
    assert spans > 4
    results = reach.greedy_results(skew).collect()
    got = {r["certificate_id"]: (r["greedy_cost_mid"], r["n_recs_needed"]) for r in results if r["covered"]}
    by_age_df, by_type_df, glob_df = reach.uplift_lookup(long)
    want = brute_force(recs.collect(), ({(r[0], r[1]): r[2] for r in by_age_df.collect()},
                                        {r[0]: r[1] for r in by_type_df.collect()}, glob_df.first()["u_global"]))
    assert got == want and "HOT" in got
    assert {r["certificate_id"] for r in results} == {r[0] for r in rows}
