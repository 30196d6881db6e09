"""Path attribution: additivity and agreement with the forest's own predictions."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from hearth.operators import ml


def test_path_attribution_is_additive(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(400, 4))
    y = 3 * X[:, 0] - 2 * X[:, 1] * (X[:, 2] > 0) + rng.normal(scale=0.1, size=400)
    df = spark.createDataFrame([(i, *map(float, x), float(t)) for i, (x, t) in enumerate(zip(X, y))],
                               "id int, a double, b double, c double, d double, y double")
    feats = ["a", "b", "c", "d"]
    data = ml.assemble(df, feats)
    model = RandomForestRegressor(numTrees=12, maxDepth=5, seed=1, labelCol="y").fit(data)
    trees = ml._pack(ml.forest_nodes(model, spark))
    att = ml.attribute(data, feats, ["id"], trees, spark)
    pred = model.transform(data).select("id", F.col("prediction").alias("p_model"))
    rows = att.join(pred, "id").collect()
    assert len(rows) == 400
    for r in rows:
        total = r["bias"] + sum(r[f"c_{f}"] for f in feats)
        assert total == pytest.approx(r["prediction"], abs=1e-9)
        assert r["prediction"] == pytest.approx(r["p_model"], abs=1e-9)


def test_encoded_columns_split_as_numbers(spark):
    """Codes keep their nominal metadata unless it is cleared; a forest that splits on categories is refused."""
    from pyspark.ml.feature import StringIndexer
    rows = [(i, "abcdefgh"[i * 7 % 8], float(i % 11), float((i * 7 % 8) ** 2 % 5 + (i % 11) / 4)) for i in range(600)]
    raw = spark.createDataFrame(rows, "id int, kind string, x double, y double")
    coded = StringIndexer(inputCol="kind", outputCol="code", stringOrderType="alphabetAsc").fit(raw).transform(raw)
    forest = RandomForestRegressor(numTrees=8, maxDepth=5, seed=3, labelCol="y")
    nominal = forest.fit(ml.assemble(coded, ["code", "x"]))
    with pytest.raises(ValueError, match="categories"):
        ml.forest_nodes(nominal, spark)
    data = ml.assemble(coded.withMetadata("code", {}), ["code", "x"])
    model = forest.fit(data)
    own = model.transform(data).select("id", "code", "x", F.col("prediction").alias("own"))
    for r in ml.attribute(own, ["code", "x"], ["id", "own"], ml._pack(ml.forest_nodes(model, spark)), spark).collect():
        assert r["prediction"] == pytest.approx(r["own"], abs=1e-9)


def test_no_shared_folder_on_a_cluster_is_an_error():
    from types import SimpleNamespace

    from hearth.session import ensure_checkpoint_dir
    context = SimpleNamespace(master="spark://host:7077", getConf=dict, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context))
