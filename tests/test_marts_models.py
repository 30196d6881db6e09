"""Marts over views and bucketed tables, batched k-means, Ward's merges, distinct counts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.operators import ml, ward
from hearth.operators.profile import distinct_counts
from hearth.plans import marts
from tests.conftest import SF_SMALL


def test_bucketed_join_needs_no_exchange(spark):
    names = marts.catalog_tables(spark, SF_SMALL)
    joined = spark.sql(f"SELECT /*+ MERGE(r, c) */ r.cost_mid, c.borough FROM {names['recommendations']} r JOIN {names['certificates']} c "
                       "ON r.certificate_id = c.certificate_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {names['certificates']}").collect()}
    assert described["Num Buckets"] == "16" and described["Bucket Columns"] == "[`certificate_id`]"


def test_raw_views_check_the_header(spark, tmp_path):
    """The path is a session variable; a file whose header is not the declared one is refused, not misread."""
    (tmp_path / "c").mkdir()
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.csv").write_text("certificate_number,improvement_item,improvement_id,improvement_summary_text,indicative_cost\n"
                                          'C1,1,5,Loft,"£1,000 - £2,000"\nC1,2,6,Wall,£30\nC2,1,,x,\n')
    (tmp_path / "c" / "a.csv").write_text("wrong,header\n1,2\n")
    marts.declare_raw_views(spark, {"raw_certificates": str(tmp_path / "c"), "raw_recommendations": str(tmp_path / "r")})
    assert [tuple(r) for r in spark.sql("SELECT certificate_id, cost_mid FROM stg_recommendations ORDER BY 1, 2").collect()] == [
        ("C1", 30.0), ("C1", 1500.0), ("C2", None)]
    with pytest.raises(Exception, match="(?i)header"):
        spark.sql("SELECT * FROM stg_certificates").collect()


def test_distinct_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (None, "b"), (2, "")], "x int, y string")
    out = distinct_counts(df, {"n_x": F.col("x"), "n_y": F.col("y")})
    assert tuple(out.first()) == (2, 3)
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert tuple(distinct_counts(df.limit(0), {"n_x": F.col("x")}).first()) == (0,)


def test_batched_kmeans(spark):
    """Separated blobs are found for every k asked for; models are fixed points of the rounds; reruns agree."""
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(c, 0.2, (60, 2)) for c in ((0, 0), (8, 0), (0, 8))])
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], "a double, b double").repartition(4)
    found = ml.kmeans_models(df, ["a", "b"], [2, 3, 5], seeds=range(3))
    cost, centres = found[3]
    assert sorted(np.round(centres).tolist()) == [[0, 0], [0, 8], [8, 0]] and found[2][0] > cost > found[5][0]
    d = ((points[:, None] - centres) ** 2).sum(2)
    assert cost == pytest.approx(d.min(1).sum())
    for j in range(3):
        assert centres[j] == pytest.approx(points[d.argmin(1) == j].mean(0))
    again = ml.kmeans_models(df.repartition(2), ["a", "b"], [2, 3, 5], seeds=range(3))
    assert all(again[k][0] == pytest.approx(found[k][0]) for k in found)
    labelled = ml.kmeans_best(df, ["a", "b"], 3, seeds=range(3))
    assert sorted(r["count"] for r in labelled.groupBy("cluster").count().collect()) == [60, 60, 60]
    assert ml.kmeans_models(df.limit(0), ["a", "b"], [2]) == {}


def test_first_centres_are_drawn_from_all_rows(spark):
    """The draws are those of k-means++ over the whole table in its order, however it is cut; none is left out."""
    rng = np.random.default_rng(5)
    points = np.round(rng.normal(0, 1, (9000, 2)), 3)
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], "a double, b double")
    steady = [F.round(F.col(c), 6) for c in ("a", "b")]
    stored = df.repartition(3).orderBy(F.xxhash64(*steady), *steady).withColumn("_part", F.spark_partition_id()).localCheckpoint()
    whole = np.array(stored.select("a", "b").collect())
    found = ml._first_centres(stored, 4, range(6))
    for seed, centres in found.items():
        draw = np.random.default_rng(seed)
        want = [whole[draw.integers(len(whole))]]
        while len(want) < 4:
            near = ((whole[:, None] - np.array(want)) ** 2).sum(2).min(1)
            want.append(whole[draw.choice(len(whole), p=near / near.sum())])
        assert centres == pytest.approx(np.array(want))
    first = {tuple(p) for p in whole[:4096]}
    assert any(tuple(c) not in first for centres in found.values() for c in centres)
    alike = stored.limit(5).selectExpr("0D AS a", "0D AS b", "0 AS _part").localCheckpoint()
    assert ml._first_centres(alike, 3, [1])[1].tolist() == [[0, 0]] * 3


def test_kmeans_refills_empty_centres_and_runs_to_the_end(spark, monkeypatch):
    """A centre without rows goes to the farthest row; rounds go on until no centre moves, more than fifty of them."""
    line = spark.createDataFrame([(float(i),) for i in range(400)], "a double")
    monkeypatch.setattr(ml, "_first_centres", lambda rows, k, seeds: {s: np.array([[0.0], [1.0], [2.0]]) for s in seeds})
    cost, centres = ml.kmeans_models(line, ["a"], [3], [1])[3]
    x = np.arange(400.0)
    own = np.abs(x[:, None] - centres.ravel()).argmin(1)
    assert centres.ravel() == pytest.approx([x[own == j].mean() for j in range(3)]) and np.bincount(own).min() > 100
    monkeypatch.setattr(ml, "_first_centres", lambda rows, k, seeds: {s: np.array([[0.0], [1.0], [-900.0]]) for s in seeds})
    three = spark.createDataFrame([(0.0,), (1.0,), (9.0,)], "a double")
    cost, centres = ml.kmeans_models(three, ["a"], [3], [1])[3]
    assert cost == 0 and sorted(centres.ravel()) == [0, 1, 9]


def test_sweep_silhouettes_are_euclidean_over_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = [(f"b{i}", k, int(c), *map(float, rng.normal(c, 1.5, 2))) for k in (2, 3) for i, c in enumerate(rng.integers(0, k, 90))]
    rows += [("alone", 3, 7, 50.0, 50.0), ("t0", 4, 0, 1.0, 1.0), ("t1", 4, 0, 1.0, 1.0), ("t2", 4, 1, 1.0, 1.0), ("t3", 4, 1, 1.0, 1.0), ("one", 5, 0, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "id string, k int, c int, x double, y double").repartition(5)
    out = ml.pairwise_silhouettes(df, ["x", "y"], "c", "k")
    assert out.columns == [*df.columns, "silhouette"]
    got = {(r["k"], r["id"]): r["silhouette"] for r in out.collect()}
    assert len(got) == len(rows)
    for k in (2, 3, 4, 5):
        mine = [r for r in rows if r[1] == k]
        X, lab = np.array([r[3:] for r in mine]), np.array([r[2] for r in mine])
        D = np.sqrt(((X[:, None] - X) ** 2).sum(2))
        for i, r in enumerate(mine):
            own = lab == lab[i]
            b = min((D[i, lab == c].mean() for c in set(lab) - {lab[i]}), default=0)
            a = D[i, own].sum() / max(own.sum() - 1, 1)
            assert got[k, r[0]] == pytest.approx((b - a) / max(a, b) if own.sum() > 1 and max(a, b) > 0 else 0, abs=1e-12)


def brute_ward(points):
    """Ward's merges by trying every pair in every step."""
    live, out = {i: (np.array(p, float), 1) for i, p in enumerate(points)}, []
    while len(live) > 1:
        cost, a, b = min((n * m / (n + m) * ((x - y) ** 2).sum(), i, j) for i, (x, n) in live.items() for j, (y, m) in live.items() if i < j)
        (x, n), (y, m) = live.pop(a), live.pop(b)
        live[len(points) + len(out)] = ((x * n + y * m) / (n + m), n + m)
        out.append((a, b, (2 * cost) ** 0.5, n + m))
    return out


def test_ward_merges(spark):
    rng = random.Random(7)
    points = sorted([rng.gauss(0, 1), rng.gauss(0, 2), rng.random()] for _ in range(60))
    made = ward.merges(np.ones(60, int), np.array(points))
    expected = brute_ward(points)
    assert [(a, b, round(h, 9), n) for a, b, h, n in made] == [(a, b, round(h, 9), n) for a, b, h, n in expected]
    df = spark.createDataFrame([tuple(p) for p in points], "x double, y double, z double").repartition(3)
    _, cells, through = ward.linkage(df, ["x", "y", "z"])
    assert cells == points and [round(h, 9) for _, _, h, _ in through] == [round(h, 9) for _, _, h, _ in expected]
    out = ward.with_clusters(df, ["x", "y", "z"], 4, "tier", ward.linkage(df, ["x", "y", "z"])).collect()
    assert len(out) == 60 and {r["tier"] for r in out} == {0, 1, 2, 3}
    many = spark.createDataFrame([(rng.choice([0.0, 50.0]) + rng.random(), rng.random(), None if i % 50 == 0 else 1.0) for i in range(900)], "x double, y double, z double")
    found = ward.linkage(many, ["x", "y", "z"], max_leaves=40)
    assert found[0] > 0 and 1 < len(found[1]) <= 40 and found[2][-1][3] == 882
    halves = ward.with_clusters(many, ["x", "y", "z"], 2, "tier", found)
    assert halves.where("tier is null").count() == 18
    assert halves.where("tier is not null").groupBy("tier").agg(F.max("x") - F.min("x")).agg(F.max("(max(x) - min(x))")).first()[0] < 2
    assert ward.linkage(df.limit(0), ["x", "y", "z"]) == (0.0, [], [])
