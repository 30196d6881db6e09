"""The forest's walk, its memberships and the partitions it is fitted on; the join that the retrofit layer is built with."""

import datetime
import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from hearth.operators import ml


@pytest.fixture
def forest(spark):
    rng = np.random.default_rng(3)
    rows = [(f"p{i}", float(a), float(b), float(2 * a - b)) for i, (a, b) in enumerate(rng.integers(0, 9, size=(300, 2)))]
    data = ml.assemble(spark.createDataFrame(rows, "id string, a double, b double, y double"), ["a", "b"])
    model = RandomForestRegressor(numTrees=7, maxDepth=4, seed=1, labelCol="y").fit(data)
    return data, ml._pack(ml.forest_nodes(model, spark))


def _plain(x, tree):
    pred, left, right, feat, thr = tree
    node, depth, credit = 0, 0, [0.0, 0.0]
    while left[node] >= 0:
        to = left[node] if x[feat[node]] <= thr[node] else right[node]
        credit[feat[node]] += pred[to] - pred[node]
        node, depth = to, depth + 1
    return node, depth, credit


def test_members_are_a_row_per_property_with_every_tree(spark, forest):
    data, trees = forest
    rows = ml.leaf_members(data, ["a", "b"], "id", trees, spark).join(data.select("id", "a", "b"), "id").collect()
    assert len(rows) == 300
    for r in rows:
        assert [tuple(x) for x in r["leaves"]] == [(i, *_plain((r["a"], r["b"]), t)[:2]) for i, t in enumerate(trees)]


def test_members_as_arrays_are_the_same(spark, forest):
    data, trees = forest
    whole = {r["id"]: [tuple(x) for x in r["leaves"]] for r in ml.leaf_members(data, ["a", "b"], "id", trees, spark).collect()}
    rows = ml.leaf_members(data, ["a", "b"], "id", trees, spark, ["y", "a"], arrays=True)
    assert rows.columns == ["id", "y", "a", *ml.LEAF_ARRAYS]
    given = {r["id"]: r for r in data.collect()}
    for r in rows.collect():
        assert [*zip(r["trees"], r["nodes"], r["depths"])] == whole.pop(r["id"]) and (r["y"], r["a"]) == (given[r["id"]]["y"], given[r["id"]]["a"])
    assert not whole


def test_votes_look_every_leaf_up_in_the_stored_nodes(spark, forest):
    """Mean prediction and depth of a row's leaves; nodes that are no leaf, of no tree or of a tree met before are not found."""
    data, trees = forest
    rng = np.random.default_rng(1)
    leaves = [[int(x) for x in np.flatnonzero(t[1] < 0)] for t in trees]
    inner = int(np.flatnonzero(trees[0][1] >= 0)[0])
    whole = [[(i, int(rng.choice(at)), int(rng.integers(0, 5))) for i, at in enumerate(leaves)] for _ in range(50)]
    odd = [[], [(0, inner, 1)], [(0, leaves[0][0], 2), (0, leaves[0][-1], 3)], [(7, 1, 1), (-1, 0, 1), (1, 10**6, 1), (2, -1, 4)], None]
    members = spark.createDataFrame([(i, *([t[j] for t in x] if x is not None else None for j in range(3))) for i, x in enumerate(whole + odd)],
                                    "id int, trees array<int>, nodes array<int>, depths array<int>")
    nodes = pd.concat([pd.DataFrame({"treeID": i, "id": range(len(t[0])), "prediction": t[0], "left": t[1]}) for i, t in enumerate(trees)])
    out = {r["id"]: tuple(r)[1:] for r in ml.leaf_votes(members, ["id"], nodes.sample(frac=1, random_state=1), spark).collect()}
    for i, x in enumerate(whole):
        assert out[i][:2] == (7, 7) and out[i][3] == max(d for *_, d in x)
        assert out[i][2] == pytest.approx(np.mean([trees[t][0][n] for t, n, _ in x]), abs=1e-12)
    first = pytest.approx(trees[0][0][leaves[0][0]])
    assert [out[50 + i] for i in range(5)] == [(0, 0, None, 0), (1, 0, None, 1), (2, 1, first, 3), (4, 0, None, 4), (0, 0, None, 0)]


def _small_tables(spark, sf):
    """Tables of four areas, with orders enough for a forest."""
    rng = random.Random(4)
    tables = {
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(i, f"AREA {i}", i % 3) for i in range(4)]),
        "customer": ("c_custkey long, c_nationkey long", [(i, i % 4) for i in range(300)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date",
                   [(i, rng.randrange(300), "FP"[i % 2], datetime.date(1995, 1 + i % 12, 3)) for i in range(1500)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int",
                     [(rng.randrange(1500), rng.choice([0, *range(3, 100)]), rng.randrange(100), 1 + i % 4) for i in range(18000)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{sf}/{name}.parquet")
    return sf


def test_forest_check_reads_memberships_once_and_sees_faults(spark, tmp_path, monkeypatch):
    """One pass over memberships that are not exploded, and no table of parsed recommendations; each kind of fault is counted."""
    import os

    from hearth.plans import model_checks
    from hearth.session import scratch_path
    sf = _small_tables(spark, str(tmp_path))
    out = model_checks.forest_check(spark, sf)
    good = out.first().asDict()
    assert good["n_trees"] == 100 and good["n_rows"] > 500 and sum(v for k, v in good.items() if k not in ("n_trees", "n_rows")) == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "inline" not in plan   # the walk, and the look at its leaves
    where = hashlib.sha1(f"{sf}|".encode()).hexdigest()[:16]
    assert sorted(os.listdir(scratch_path(spark, f"silver/{where}"))) == ["homes", "recommended"]

    walk = ml.leaf_members
    spoilt = {"n_lost_rows": ("nodes", "transform(nodes, x -> 0)"), "n_too_deep": ("depths", "transform(depths, x -> x + 12)"),
              "n_other_prediction": ("nodes", "first")}
    for fault, (column, how) in spoilt.items():
        def members(*args, **kw):
            rows = walk(*args, **kw)
            return rows.crossJoin(rows.limit(1).selectExpr("nodes AS first")).withColumn(column, F.expr(how)).drop("first")
        monkeypatch.setattr(ml, "leaf_members", members)
        bad = model_checks.forest_check(spark, sf).first().asDict()
        assert bad[fault] > 400 and bad["n_rows"] == good["n_rows"]


def test_model_tables_check_makes_each_table_once_and_sees_faults(spark, tmp_path, monkeypatch):
    """Features, contributions and the greedy rows are made once; a wrong cell or cover is still counted."""
    from hearth.plans import analytics, model_checks, reach
    sf = _small_tables(spark, str(tmp_path))
    made = []
    for module, name in ((analytics, "ml_table"), (ml, "attribute"), (reach, "greedy_rows")):
        def counted(*args, _does=getattr(module, name), _name=name, **kw):
            made.append(_name)
            return _does(*args, **kw)
        monkeypatch.setattr(module, name, counted)
    good = model_checks.model_tables_check(spark, sf).first().asDict()
    assert sorted(made) == ["attribute", "greedy_rows", "ml_table"]
    assert good["n_types"] > 5 and good["n_wrong_cells"] == good["n_wrong_covers"] == 0 and good["n_areas"] == 4 and good["n_below"] > 100
    long, cover = analytics.model_attribution_long, reach.greedy_cover
    with monkeypatch.context() as m:
        m.setattr(analytics, "model_attribution_long", lambda *a: long(*a).withColumn("overall_avg_pts", F.col("overall_avg_pts") + 0.1))
        assert model_checks.model_tables_check(spark, sf).first()["n_wrong_cells"] > 5
    monkeypatch.setattr(reach, "greedy_cover", lambda results: cover(results).withColumn("n_recs_needed", F.col("n_recs_needed") + 1))
    assert model_checks.model_tables_check(spark, sf).first()["n_wrong_covers"] > 10


def test_recommended_is_a_part_of_the_base(spark, tmp_path):
    """The narrow table has the rows that the base has, and is read from the base where that is there."""
    import os

    from hearth.plans import layers
    from hearth.session import scratch_path
    sf = _small_tables(spark, str(tmp_path))
    canon = lambda df: sorted(map(str, df.collect()))
    narrow = canon(layers.recommended(spark, sf))
    base = layers.retrofit_base(spark, sf)
    assert narrow == canon(base.select("certificate_id", "improvement_type")) == canon(layers.recommended(spark, sf)) and len(narrow) > 5000
    layers.recommended(spark, sf, "tagged")
    layers.retrofit_base(spark, sf, "again")
    layers.recommended(spark, sf, "again")
    there = lambda tag: sorted(os.listdir(scratch_path(spark, f"silver/{hashlib.sha1(f'{sf}|{tag}'.encode()).hexdigest()[:16]}")))
    assert there("tagged") == ["homes", "recommended"] and there("again") == ["homes", "retrofit_base"]


def test_contributions_are_those_of_a_plain_walk(forest):
    _, trees = forest
    X = np.array([[0, 0], [4, 8], [8, 1], [np.nan, 3]], float)
    _, contrib, pred = ml.path_contributions(X, ml.Walk(trees, 2))
    for x, c, p in zip(X, contrib, pred):
        walks = [_plain(x, t) for t in trees]
        assert c == pytest.approx(np.mean([w[2] for w in walks], 0), abs=1e-12)
        assert p == pytest.approx(np.mean([t[0][w[0]] for w, t in zip(walks, trees)]), abs=1e-12)


def test_training_partitions_are_bounded_and_even(spark, monkeypatch):
    monkeypatch.setattr(ml, "TRAIN_ROWS", 100)
    cores = spark.sparkContext.defaultParallelism
    rows = 100 * cores * 2 + 1
    sizes = [r["count"] for r in ml.even_parts(spark.range(rows).coalesce(1)).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == rows and len(sizes) == 3 * cores and max(sizes) <= 100
    assert ml.even_parts(spark.range(90).coalesce(1)).rdd.getNumPartitions() == 1


def test_wide_recommendations_are_not_sorted_for_their_join(spark):
    from hearth.plans import silver
    from tests.conftest import SF_SMALL
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        certs = silver.certificates_silver(spark, SF_SMALL).localCheckpoint()
        plan = silver.joined_recommendations(spark, SF_SMALL, certs)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_rollup_reports_read_narrow_homes_and_write_no_wide_rows(spark, tmp_path):
    """Reports of the rollup build neither the wide certificates nor a table of single rows; what they add up is the same."""
    import os

    from hearth.plans import layers, retrofit, silver
    from hearth.plans import queries  # noqa: F401  registers
    from hearth.plans.catalog import all_queries
    from hearth.session import scratch_path
    rng = random.Random(8)
    sf = str(tmp_path)
    tables = {
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(i, f"AREA {i}", i % 3) for i in range(4)]),
        "customer": ("c_custkey long, c_nationkey long", [(i, i % 4) for i in range(60)] + [(3, 3), (None, 1), (60, None)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date",
                   [(i % 280 if i else None, rng.randrange(61), rng.choice(["F", "P", "O", None]), datetime.date(1995, 1 + i % 12, 3)) for i in range(300)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int",
                     [(rng.choice([None, *range(300)]), rng.randrange(200), rng.randrange(100), 1 + i % 4) for i in range(1500)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{sf}/{name}.parquet")
    for name in ("first_ranked_types", "area_category_costs"):
        assert all_queries()[name](spark, sf).count() > 0
    where = hashlib.sha1(f"{sf}|".encode()).hexdigest()[:16]
    assert sorted(os.listdir(scratch_path(spark, f"silver/{where}"))) == ["homes", "retrofit_rollup"]
    canon = lambda df: sorted(map(str, df.collect()))
    base = layers.retrofit_base(spark, sf)
    assert canon(layers.retrofit_rollup(spark, sf)) == canon(retrofit.rollup(base)) and base.count() > 50
    assert base.columns[:5] == ["certificate_id", "priority", "improvement_id", "improvement_type", "indicative_cost"]
    whole = silver.certificates_silver(spark, sf)
    assert canon(layers.homes(spark, sf)) == canon(layers.certificates(spark, sf).select(*layers.HOME_COLUMNS))
    # the sort of the dedup carries no column that no report reads
    plan = whole.select(*layers.HOME_COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert "energy_consumption" not in plan and "main_fuel" not in plan


def test_area_models_build_narrow_tables_only(spark, tmp_path):
    """The features that the k sweep and its check read come of narrow homes and of the rollup; no wide table is written for them."""
    import os

    from hearth.plans import analytics
    from hearth.session import scratch_path
    sf = str(tmp_path)
    tables = {
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(i, f"AREA {i}", i % 3) for i in range(4)]),
        "customer": ("c_custkey long, c_nationkey long", [(i, i % 4) for i in range(60)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date",
                   [(i, i % 60, "FP"[i % 2], datetime.date(1995, 1 + i % 12, 3)) for i in range(300)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int", [(i % 300, i % 200, i % 97, 1 + i % 4) for i in range(1200)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{sf}/{name}.parquet")
    assert analytics.area_features(spark, sf).count() == 4
    where = hashlib.sha1(f"{sf}|".encode()).hexdigest()[:16]
    assert sorted(os.listdir(scratch_path(spark, f"silver/{where}"))) == ["homes", "retrofit_rollup"]
