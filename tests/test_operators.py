"""Generic operators: quality rules, exact quantiles, profiles, ranking, silhouette."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.operators import profile as P
from hearth.operators.quality import accepted_range, check_table, not_null, ordered, row_count, sums_to, unique
from hearth.operators.ranking import composite_rank
from hearth.operators.stats import exact_quantiles


def test_check_table(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 60.0, 40.0), ("a", 5.0, 4.0, 6.0, 50.0, 50.0),
                                (None, None, 1.0, 2.0, 10.0, 20.0)],
                               "k string, lo double, mid double, hi double, p1 double, p2 double")
    rep = check_table(df, "t", [not_null("k"), unique("k"), accepted_range("lo", 0, 4), ordered("lo", "mid", "hi"),
                                sums_to(["p1", "p2"], 100), row_count(3)])
    got = {(r["rule"], r["column_name"]): r["n_violations"] for r in rep.collect()}
    assert got == {("not_null", "k"): 1, ("unique", "k"): 1, ("accepted_range", "lo"): 1,
                   ("ordered", "lo<=mid<=hi"): 1, ("sums_to", "p1+p2"): 1, ("row_count", "*"): 0}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    g = rng.integers(0, 4, 300)
    v = rng.integers(0, 50, 300).astype(float)     # many duplicates
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v)], "g int, v double")
    out = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"med": 0.5, "p9": 0.9}).collect()}
    for k in range(4):
        vals = v[g == k]
        assert out[k]["med"] == pytest.approx(np.percentile(vals, 50))
        assert out[k]["p9"] == pytest.approx(np.percentile(vals, 90))
    whole = exact_quantiles(df, [], "v", {"med": 0.5}, extra=[F.count(F.lit(1)).alias("n")]).first()
    assert whole["med"] == pytest.approx(np.percentile(v, 50)) and whole["n"] == 300


def test_null_and_blank_audit(spark):
    df = spark.createDataFrame([("a", float("nan")), ("", 1.0), (None, None)], "s string, x double")
    nulls = {r["column_name"]: r["nulls"] for r in P.null_audit(df).collect()}
    assert nulls == {"s": 1, "x": 2}
    blanks = {r["column_name"]: (r["blanks"], r["pct_blank"]) for r in P.blank_audit(df, ["s"]).collect()}
    assert blanks == {"s": (2, 66.7)}


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    assert [tuple(r) for r in P.value_counts(df, "c").collect()] == [("b", 2), ("a", 1), (None, 1)]


def test_composite_rank(spark):
    df = spark.createDataFrame([("x", 50.0, 0.2, 30.0), ("y", 40.0, 0.3, 30.0), ("z", 40.0, 0.1, 10.0)],
                               "borough string, a double, b double, c double")
    out = {r["borough"]: r for r in composite_rank(df, {"ra": "a", "rb": "b", "rc": "c"}).collect()}
    assert (out["x"]["ra"], out["x"]["rb"], out["x"]["rc"]) == (1, 2, 1)
    assert out["x"]["priority_score"] == 1.3 and out["x"]["priority_rank"] == 1
    assert out["y"]["priority_score"] == 1.3 and out["y"]["priority_rank"] == 1   # tie shares the rank
    assert out["z"]["priority_score"] == 2.3 and out["z"]["priority_rank"] == 2


def test_silhouette_closed_form_matches_pairwise(spark):
    from hearth.operators.ml import silhouette_rows
    rng = np.random.default_rng(0)
    X = np.vstack([rng.normal(0, 1, (8, 2)), rng.normal(5, 1, (7, 2)), rng.normal([0, 6], 1, (5, 2))])
    lab = np.array([0] * 8 + [1] * 7 + [2] * 5)
    lab[3] = 1
    df = spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(X, lab))],
                               "id int, x double, y double, c int")
    got = {r["id"]: r["silhouette"] for r in silhouette_rows(df, ["x", "y"], "c").collect()}
    D = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    for i in range(len(X)):
        own = lab == lab[i]
        a = D[i, own].sum() / (own.sum() - 1) if own.sum() > 1 else None
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s = 0.0 if a is None else (b - a) / max(a, b)
        assert got[i] == pytest.approx(s)


def test_running_sum_keeps_null_groups_and_spans_slices(spark):
    from hearth.operators.prefix import running_sum
    rows = [(g, i, (i * 7) % 5) for g in (None, "a", "b") for i in range(400 if g is None else 30)]
    df = spark.createDataFrame(rows, "g string, i int, w long")
    out = running_sum(df, ["g"], [F.asc("i")], "w", "total", 8)
    want, total = {}, {}
    for g, i, w in rows:
        total[g] = want[g, i] = total.get(g, 0) + w
    got = {(r["g"], r["i"]): r["total"] for r in out.collect()}
    assert got == want
    assert out.where("g is null").select("_p").distinct().count() > 1
