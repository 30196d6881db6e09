"""MLlib operators: PCA, k-means sweeps, silhouettes, forest fit and path attribution.

Every model step is an MLlib estimator over a DataFrame, so it runs the same
on a 20-row area table and on a property table. What reaches the driver is
the model itself (centroids, principal components, tree nodes) — bounded by
the model's size, never by the data.
"""

from __future__ import annotations

import sys
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable, scratch_path


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


# ------------------------------------------------------------------ PCA (M4, M5)

def pca(df: DataFrame, cols: list[str], k: int, anchor: F.Column | None = None):
    """Principal components of already-standardised ``cols``.

    Returns (scored df with pc1..pck, loadings rows, explained variance list).
    With ``anchor`` (a boolean column selecting one row), PC1 is flipped so the
    anchor row scores positive (M5); every other component is flipped so that its
    largest loading is positive.
    """
    feat = assemble(df, cols, "_x")
    model = PCA(k=k, inputCol="_x", outputCol="_pc").fit(feat)
    pcs = np.array(model.pc.toArray(), copy=True)  # (n_features, k), tiny
    scored = model.transform(feat).withColumn("_pca", vector_to_array("_pc")).drop("_x", "_pc")
    for i in range(k):
        scored = scored.withColumn(f"pc{i + 1}", F.col("_pca")[i])
    scored = scored.drop("_pca")
    if anchor is not None:
        sign = scored.agg(F.max(F.when(anchor, F.signum("pc1")))).first()[0]
        if sign is not None and sign < 0:
            scored = scored.withColumn("pc1", -F.col("pc1"))
            pcs[:, 0] = -pcs[:, 0]
    for i in range(0 if anchor is None else 1, k):   # the other signs are free: the largest loading is made positive
        if pcs[np.abs(pcs[:, i]).argmax(), i] < 0:
            scored = scored.withColumn(f"pc{i + 1}", -F.col(f"pc{i + 1}"))
            pcs[:, i] = -pcs[:, i]
    loadings = [(c, *[float(pcs[j, i]) for i in range(k)]) for j, c in enumerate(cols)]
    return scored, loadings, [float(v) for v in model.explainedVariance.toArray()]


# ------------------------------------------------------------------ k-means

def _first_centres(rows: DataFrame, k: int, seeds) -> dict[int, np.ndarray]:
    """k-means++ over all rows, at most ``k`` centres a seed: each next one is drawn with odds of its squared distance to the nearest one.

    ``rows`` (the columns, and last the number of the partition) lie in one order. A pass adds up the odds by partition and
    seed, the driver draws a place in their sum, and a second pass fetches the row there. What reaches the driver is a
    number per partition and seed, and a row per seed. The centres of a smaller k are the first ones of the same seed.
    """
    seeds, cols, part = list(seeds), rows.columns[:-1], rows.columns[-1]
    rngs, chains = [np.random.default_rng(s) for s in seeds], [np.empty((0, len(cols))) for _ in seeds]

    def odds(x, chain, even):
        return np.ones(len(x)) if even else ((x[:, None, :] - chain) ** 2).sum(2).min(1)

    def added(even: list[bool]) -> dict[int, list[float]]:
        def run(batches):
            total, at = np.zeros(len(chains)), None
            for pdf in batches:
                if len(pdf):
                    x, at = pdf[cols].to_numpy(dtype=float), int(pdf[part].iloc[0])
                    total += [odds(x, c, e).sum() for c, e in zip(chains, even)]
            if at is not None:
                yield pd.DataFrame({"at": [at], "total": [total.tolist()]})
        return {r["at"]: r["total"] for r in rows.mapInPandas(run, "at int, total array<double>").collect()}

    def fetched(places: list[tuple[int, float]], even: list[bool]) -> list[list[float]]:
        def run(batches):
            passed, last, open_ = [0.0] * len(places), {}, set(range(len(places)))
            for pdf in batches:
                if not len(pdf):
                    continue
                x = pdf[cols].to_numpy(dtype=float)
                for i in [i for i in open_ if places[i][0] == pdf[part].iloc[0]]:
                    w = odds(x, chains[i], even[i])
                    upto = passed[i] + w.cumsum()
                    j = int(upto.searchsorted(places[i][1], side="right"))
                    if j < len(x):
                        open_.discard(i)
                        yield pd.DataFrame({"i": [i], "x": [x[j].tolist()]})
                    elif w.any():   # the last bits of sums may put a place behind all rows
                        last[i] = x[np.flatnonzero(w)[-1]].tolist()
                    passed[i] = upto[-1]
            for i in open_ & set(last):
                yield pd.DataFrame({"i": [i], "x": [last[i]]})
        found = {r["i"]: r["x"] for r in rows.mapInPandas(run, "i int, x array<double>").collect()}
        return [found[i] for i in range(len(places))]

    sizes = added([True] * len(seeds))
    n = int(sum(t[0] for t in sizes.values()))
    for step in range(min(k, n)):
        sums = added([False] * len(seeds)) if step else sizes
        even, places = [], []
        for i, rng in enumerate(rngs):
            even.append(sum(t[i] for t in sums.values()) <= 0 or not step)   # all rows lie on centres
            parts = [(at, (sizes if even[i] else sums)[at][i]) for at in sorted(sums)]
            place = float(rng.integers(n)) if even[i] else rng.random() * sum(t for _, t in parts)
            whole = [(at, t) for at, t in parts if t > 0]
            while len(whole) > 1 and place >= whole[0][1]:
                place -= whole.pop(0)[1]
            places.append((whole[0][0], place))
        chains = [np.vstack([c, x]) for c, x in zip(chains, fetched(places, even))]
    return dict(zip(seeds, chains))


def kmeans_models(df: DataFrame, cols: list[str], ks, seeds=range(42, 52)) -> dict[int, tuple[float, np.ndarray]]:
    """``{k: (inertia, centres)}``: the best of the seeded models of each k, ties to the lowest seed.

    All models advance together: one pass over the rows a round assigns each row to the nearest centre of every
    model still moving, and adds up their sums in the task. What is shuffled and what reaches the driver is one row
    per model and centre. A model moves until its centres are the means of their rows; a centre left without rows goes
    on from the row farthest from its own. A last pass gives the inertia of the final centres.
    """
    steady = [F.round(F.col(c), 6) for c in cols]   # the last bits of sums differ from run to run
    stored = durable(df.select(*[F.col(c).cast("double").alias(c) for c in cols]).orderBy(F.xxhash64(*steady), *steady)
                     .withColumn("_part", F.spark_partition_id()))
    ks, seeds = list(ks), list(seeds)
    first = _first_centres(stored, max(ks), seeds)
    if not any(len(c) for c in first.values()):
        return {}
    models = {(k, s): first[s][:k].copy() for k in ks for s in seeds}
    names = list(models)
    rows, d = stored.drop("_part"), len(cols)

    def sums(moving: list[tuple[int, int]]):
        centres = [models[m] for m in moving]   # bounded by the models asked for

        def run(batches):
            n = [np.zeros(len(c)) for c in centres]
            s = [np.zeros((len(c), d)) for c in centres]
            cost = [0.0] * len(centres)
            for pdf in batches:
                x = pdf.to_numpy(dtype=float)
                for i, c in enumerate(centres):
                    distance = ((x[:, None, :] - c) ** 2).sum(2)
                    own = distance.argmin(1)
                    cost[i] += distance[np.arange(len(x)), own].sum()
                    n[i] += np.bincount(own, minlength=len(c))
                    np.add.at(s[i], own, x)
            yield pd.DataFrame([(i, j, n[i][j], s[i][j].tolist(), cost[i] if j == 0 else 0.0) for i, c in enumerate(centres) for j in range(len(c))],
                               columns=["model", "centre", "n", "s", "cost"])
        parts = rows.mapInPandas(run, "model int, centre int, n double, s array<double>, cost double")
        return parts.groupBy("model", "centre").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[j]) for j in range(d)]).alias("s"), F.sum("cost").alias("cost")).collect()

    def farthest(centres: np.ndarray, n: int) -> list[np.ndarray]:
        far = rows.withColumn("_far", nearest_centre(cols, centres)[1]).where("_far > 0").orderBy(F.desc(F.round("_far", 6)), *steady)
        return [np.array(r[:d]) for r in far.limit(n).collect()]   # at most the model's centres
    moving, last = names, dict.fromkeys(names, np.inf)
    while moving:
        before, cost, empty = {m: models[m].copy() for m in moving}, dict.fromkeys(moving, 0.0), {}
        for r in sums(moving):
            m = moving[r["model"]]
            cost[m] += r["cost"]
            if r["n"] > 0:
                models[m][r["centre"]] = np.array(r["s"]) / r["n"]
            else:
                empty.setdefault(m, []).append(r["centre"])
        for m, at in empty.items():
            for j, x in zip(sorted(at), farthest(before[m], len(at))):
                models[m][j] = x
        # the cost falls in every round that moves a row; the last bits of sums move none
        moving, last = [m for m in moving if np.abs(models[m] - before[m]).max() > 1e-9 and cost[m] < last[m]], cost
    cost = dict.fromkeys(names, 0.0)
    for r in sums(names):
        cost[names[r["model"]]] += r["cost"]
    best = {k: min((m for m in names if m[0] == k), key=lambda m: (round(cost[m], 9), m[1])) for k in ks}
    return {k: (cost[m], models[m]) for k, m in best.items()}


def nearest_centre(cols: list[str], centres: np.ndarray) -> tuple[F.Column, F.Column]:
    """(number of the nearest centre, squared distance to it), as native expressions; ties go to the lower number."""
    each = [sum(((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(cols, centre)), F.lit(0.0)) for centre in centres]
    every = F.array(*each)
    return (F.array_position(every, F.array_min(every)) - 1).cast("int"), F.array_min(every)


def kmeans_best(df: DataFrame, cols: list[str], k: int, seeds=range(42, 52)) -> DataFrame:
    """``df`` with the ``cluster`` of the best of several seeded models."""
    found = kmeans_models(df, cols, [k], seeds)
    return df.withColumn("cluster", nearest_centre(cols, found[k][1])[0] if found else F.lit(None).cast("int"))


def kmeans_assignments(df: DataFrame, key: str, cols: list[str], ks=range(2, 8), seeds=range(42, 52)) -> tuple[DataFrame, list[tuple]]:
    """(``key, k, cluster, distance`` of every row and k in one table, ``[(k, inertia)]``) of the best models."""
    found = kmeans_models(df, cols, ks, seeds)
    each = []
    for k, (_, centres) in found.items():
        cluster, distance = nearest_centre(cols, centres)
        each.append(F.struct(F.lit(k).alias("k"), cluster.alias("cluster"), distance.alias("distance")))
    long = df.select(key, *cols, F.inline(F.array(*each))) if each else df.select(key, *cols).limit(0).withColumns(
        {"k": F.lit(0), "cluster": F.lit(0), "distance": F.lit(0.0)})
    return long, [(k, inertia) for k, (inertia, _) in found.items()]


def bisecting(df: DataFrame, features: str, k: int, seed: int = 42):
    return BisectingKMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)


def relabel_by(df: DataFrame, cluster: str, measure: str, out: str) -> DataFrame:
    """Renumber clusters 0..k-1 by descending mean of ``measure`` (0 = highest).

    The per-cluster means are k rows; ranking them is a k-row window.
    """
    means = df.groupBy(cluster).agg(F.avg(measure).alias("_m"))
    order = means.withColumn(out, F.row_number().over(Window.orderBy(F.desc("_m"), F.asc(cluster))) - 1)
    return df.join(F.broadcast(order.select(cluster, out)), cluster).drop(cluster)


def silhouette_rows(df: DataFrame, features: list[str], cluster: str, out: str = "silhouette") -> DataFrame:
    """Per-row silhouette with squared-Euclidean distance (M8), in closed form.

    Mean squared distance from x to the members of cluster C is
    |x|^2 - 2 x·mean(C) + mean(|y|^2 over C), so k per-cluster sums replace
    the all-pairs distance matrix. The k sums (bounded by k, like the
    centroids) are fetched once and applied as literals: one map-side
    projection, no join. For x's own cluster the mean excludes x itself.
    """
    sq = sum((F.col(c) * F.col(c) for c in features[1:]), F.col(features[0]) * F.col(features[0]))
    stats = df.groupBy(F.col(cluster).alias("_c")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(sq).alias("_ssq"),
        *[F.sum(c).alias(f"_s_{c}") for c in features]).collect()

    def mean_d(st):
        dot = sum((F.col(c) * F.lit(st[f"_s_{c}"]) for c in features[1:]),
                  F.col(features[0]) * F.lit(st[f"_s_{features[0]}"]))
        return sq - 2 * dot / st["_n"] + F.lit(st["_ssq"]) / st["_n"]

    own = None
    for st in stats:
        n = st["_n"]
        a_c = mean_d(st) * n / (n - 1) if n > 1 else F.lit(None).cast("double")
        own = (F.when(F.col(cluster) == st["_c"], a_c) if own is None
               else own.when(F.col(cluster) == st["_c"], a_c))
    others = [F.when(F.col(cluster) != st["_c"], mean_d(st)) for st in stats]
    a = own if own is not None else F.lit(None).cast("double")
    b = F.least(*others) if len(others) > 1 else others[0]
    s = F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    return df.withColumn(out, s)


#: Slices of the members that a row is compared with: no task meets more than one of them at once.
PAIR_SLICES = 64


def pairwise_silhouettes(df: DataFrame, features: list[str], cluster: str, by: str, out: str = "silhouette") -> DataFrame:
    """Per-row silhouette with Euclidean distance among the rows equal in ``by`` (M6): every row's distance to every other one.

    A mean of distances has no closed form, so all pairs are made: rows and slices of the members meet by hash, and their
    distances are added up by row and cluster before the shuffle. A row alone in its cluster has silhouette 0.
    """
    rows = durable(df.withColumn("_row", F.monotonically_increasing_id()))
    members = rows.select(F.col(by).alias("_by"), F.col(cluster).alias("_other"), *[F.col(c).alias(f"_m_{c}") for c in features],
                          (F.col("_row") % PAIR_SLICES).alias("_of"))
    sliced = rows.select("_row", by, F.col(cluster).alias("_own"), *features, F.explode(F.sequence(F.lit(0), F.lit(PAIR_SLICES - 1))).alias("_slice"))
    square = [(F.col(c) - F.col(f"_m_{c}")) * (F.col(c) - F.col(f"_m_{c}")) for c in features]
    sums = (sliced.join(members, (F.col(by) == F.col("_by")) & (F.col("_slice") == F.col("_of")))
            .groupBy("_row", "_own", "_other").agg(F.sum(F.sqrt(sum(square[1:], square[0]))).alias("_d"), F.count(F.lit(1)).alias("_n")))
    same, a, b = F.col("_own") == F.col("_other"), F.col("_a"), F.col("_b")
    each = sums.groupBy("_row").agg(F.max(F.when(same & (F.col("_n") > 1), F.col("_d") / (F.col("_n") - 1))).alias("_a"),
                                    F.min(F.when(~same, F.col("_d") / F.col("_n"))).alias("_b"))
    value = F.when(F.greatest(a, b) > 0, F.when(a.isNotNull() & b.isNotNull(), (b - a) / F.greatest(a, b))).otherwise(F.lit(0.0))
    return rows.join(each.select("_row", F.coalesce(value, F.lit(0.0)).alias(out)), "_row").drop("_row")


# ------------------------------------------------------------------ forest

#: Rows of a partition that a forest is fitted on, at most: a task holds their tree counts and current nodes.
TRAIN_ROWS = 250_000


def even_parts(df: DataFrame) -> DataFrame:
    """``df`` in partitions of ``TRAIN_ROWS`` rows at most, a whole number of them for every core; a smaller table stays as it is.

    Every level of the trees is a stage over these partitions: one that is left over would run while the other cores wait.
    """
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * -(-rows // (cores * TRAIN_ROWS))) if rows > TRAIN_ROWS else df


def fit_forest(train: DataFrame, features: str, label: str, seed: int = 42):
    """100 trees, depth 12, >= 15 rows per leaf, sqrt features per split, seed 42.

    ``cacheNodeIds`` keeps each row's current node between passes and a larger
    ``maxMemoryInMB`` lets one pass over the data split more nodes: both change
    speed, not the fitted trees. Node-id checkpoints go to the shared folder.
    """
    return RandomForestRegressor(
        featuresCol=features, labelCol=label, numTrees=100, maxDepth=12, minInstancesPerNode=15,
        featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True, maxMemoryInMB=1024,
        checkpointInterval=10).fit(train)


def forest_nodes(model, spark, path: str | None = None) -> pd.DataFrame:
    """Flatten the forest's nodes (tree, id, prediction, children, split) via its saved form.

    ``path`` is where the model is saved already; without it the model is
    written to the shared checkpoint folder. The table is bounded by numTrees x
    2^(maxDepth+1) nodes. Splits on categories are refused: the walk compares
    with thresholds only, so encoded columns must be assembled as plain numbers.
    """
    if path is None:
        path = scratch_path(spark, f"models/forest-{uuid.uuid4().hex[:8]}")
        model.write().overwrite().save(path)
    nodes = (spark.read.parquet(f"{path}/data")
             .select("treeID", F.col("nodeData.id").alias("id"),
                     F.col("nodeData.prediction").alias("prediction"),
                     F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
                     F.col("nodeData.split.featureIndex").alias("feature"),
                     F.col("nodeData.split.leftCategoriesOrThreshold").alias("thr"),
                     F.col("nodeData.split.numCategories").alias("categories")))
    pdf = nodes.toPandas()
    if ((pdf["left"] >= 0) & (pdf["categories"] != -1)).any():
        raise ValueError("the forest splits on categories; clear the columns' nominal metadata before assembling")
    pdf = pdf.drop(columns=["categories"])
    pdf["threshold"] = pdf["thr"].map(lambda a: float(a[0]) if a is not None and len(a) else np.nan)
    return pdf.drop(columns=["thr"])


def _pack(nodes: pd.DataFrame):
    """Dense per-tree arrays indexed by node id."""
    trees = []
    for _, t in nodes.groupby("treeID"):
        n = int(t["id"].max()) + 1
        pred = np.zeros(n)
        left = np.full(n, -1, dtype=np.int64)
        right = np.full(n, -1, dtype=np.int64)
        feat = np.full(n, -1, dtype=np.int64)
        thr = np.zeros(n)
        ids = t["id"].to_numpy()
        pred[ids] = t["prediction"].to_numpy()
        left[ids] = t["left"].to_numpy()
        right[ids] = t["right"].to_numpy()
        feat[ids] = t["feature"].to_numpy()
        thr[ids] = t["threshold"].fillna(0).to_numpy()
        trees.append((pred, left, right, feat, thr))
    return trees


class Walk:
    """The packed trees made ready for many rows: children by comparison, leaves that lead to themselves, and per node what
    its path credits to each feature (the change in node mean at every split goes to the split's feature)."""

    def __init__(self, trees, n_features: int):
        self.trees, self.d = [self._ready(*t, n_features) for t in trees], n_features

    @staticmethod
    def _ready(pred, left, right, feat, thr, d):
        inner = left >= 0
        own = np.arange(len(pred))
        child = np.stack([np.where(inner, right, own), np.where(inner, left, own)], 1).ravel()   # at 2 * node + (x <= threshold)
        credit, level, depth = np.zeros((len(pred), d)), np.zeros(1, dtype=np.int64), np.zeros(len(pred), dtype=np.int32)
        while len(level := level[inner[level]]):
            for to in (left[level], right[level]):
                credit[to] = credit[level]
                credit[to, feat[level]] += pred[to] - pred[level]   # a node has one parent
                depth[to] = depth[level] + 1
            level = np.concatenate([left[level], right[level]])
        return pred, child, np.where(inner, feat, 0), thr, credit, depth

    def leaves(self, X: np.ndarray):
        """Per tree: the leaf of every row, with the tree's arrays. Continuous splits go left when x <= threshold."""
        n = len(X)
        flat, rows = np.ascontiguousarray(X.T).ravel(), np.arange(n)   # feature by feature
        for tree in self.trees:
            _, child, feat, thr, _, depth = tree
            start, node = feat * n, np.zeros(n, dtype=np.int64)
            for _ in range(int(depth.max())):
                node = child[2 * node + (flat[start[node] + rows] <= thr[node])]
            yield node, tree


def path_contributions(X: np.ndarray, trees) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per-row bias, per-feature contributions and prediction of a regression forest (packed trees, or a ``Walk`` of them).

    Walking each row down each tree, the change in node mean at every split
    is credited to the split's feature; averaging over trees gives
    bias + sum(contributions) == prediction exactly (up to float rounding).
    """
    n, d = X.shape
    walk = trees if isinstance(trees, Walk) else Walk(trees, d)
    contrib = np.zeros((n, d))
    bias = np.zeros(n)
    pred = np.zeros(n)
    for node, (p, _, _, _, credit, _) in walk.leaves(X):
        bias += p[0]
        pred += p[node]
        contrib += credit.take(node, 0)
    k = len(walk.trees)
    return bias / k, contrib / k, pred / k


#: Columns of the leaves of a row where they are plain arrays: an array of structs costs the JVM ten times as much to take over.
LEAF_ARRAYS = ("trees", "nodes", "depths")


def leaf_members(df: DataFrame, feature_cols: list[str], key: str, trees, spark, keep: list[str] | None = None, arrays: bool = False) -> DataFrame:
    """``(key, *keep, leaves array<struct<tree, node, depth>>)``: the leaf of every row in every tree of the packed forest.

    A row per property, so that its key is written once, not once a tree. With ``arrays``, the leaves are the ``LEAF_ARRAYS``.
    """
    kept = [key, *(keep or [])]
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    b_trees = spark.sparkContext.broadcast(trees)
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in df.select(*kept).schema)

    def run(batches):
        walk = Walk(b_trees.value, len(feature_cols))
        k = len(walk.trees)
        for batch in batches:
            n = batch.num_rows
            X = np.empty((n, len(feature_cols)))
            for j, c in enumerate(feature_cols):
                X[:, j] = batch.column(c).to_numpy(zero_copy_only=False)
            node, depth = np.empty((n, k), dtype=np.int32), np.empty((n, k), dtype=np.int32)
            for i, (at, tree) in enumerate(walk.leaves(X)):
                node[:, i], depth[:, i] = at, tree[-1][at]
            parts = [pa.array(np.tile(np.arange(k, dtype=np.int32), n)), pa.array(node.ravel()), pa.array(depth.ravel())]
            if not arrays:
                parts = [pa.StructArray.from_arrays(parts, names=["tree", "node", "depth"])]
            at = pa.array(np.arange(n + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[pa.ListArray.from_arrays(at, p) for p in parts]], names=[*kept, *names])
    names = LEAF_ARRAYS if arrays else ("leaves",)
    return df.select(*kept, *[c for c in feature_cols if c not in kept]).mapInArrow(run, kinds + (
        ", ".join(f"{c} array<int>" for c in names) if arrays else "leaves array<struct<tree int, node int, depth int>>"))


def leaf_votes(members: DataFrame, keep: list[str], nodes: pd.DataFrame, spark) -> DataFrame:
    """``(*keep, listed, found, prediction, depth)`` of rows with ``LEAF_ARRAYS``, by a look at every leaf in the table of ``forest_nodes``.

    ``listed`` counts the leaves of a row, ``found`` those that the table has as a leaf, of a tree not met before in the row;
    ``prediction`` is the mean of the found leaves' predictions, ``depth`` the greatest one. The table is bounded by the
    forest and broadcast as one array; a look is an index, where a join would make a row of every property and tree.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    sizes = nodes.groupby("treeID")["id"].max() + 1   # in the order of the trees, as they are packed
    starts = np.concatenate([[0], np.cumsum(sizes.to_numpy())]).astype(np.int64)
    means = np.full(starts[-1], np.nan)
    leaf = nodes[nodes["left"] < 0]
    means[starts[sizes.index.get_indexer(leaf["treeID"])] + leaf["id"].to_numpy()] = leaf["prediction"].to_numpy()
    b_table = spark.sparkContext.broadcast((starts, means))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in members.select(*keep).schema)

    def run(batches):
        starts, means = b_table.value
        for batch in batches:
            lists = [batch.column(c) for c in LEAF_ARRAYS]
            listed = np.nan_to_num(lists[0].value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            some = listed > 0
            at = (np.cumsum(listed) - listed)[some]
            tree, node, depth = (c.flatten().to_numpy(zero_copy_only=False) for c in lists)
            known = (tree >= 0) & (tree < len(starts) - 1) & (node >= 0)
            place = np.where(known, starts.take(tree, mode="clip") + node, 0)
            known &= place < starts.take(tree + 1, mode="clip")
            mean = np.where(known, means.take(place, mode="clip"), np.nan)
            later = np.ones(len(tree), dtype=bool)
            later[1:] = tree[1:] > tree[:-1]
            later[at] = True
            found = later & ~np.isnan(mean)

            def per_row(how, values):
                out = np.zeros(len(listed), dtype=values.dtype)
                if len(at):
                    out[some] = how.reduceat(values, at)
                return out
            n, total = per_row(np.add, found.astype(np.int64)), per_row(np.add, np.where(found, mean, 0.0))
            prediction = pa.array(total / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(listed), pa.array(n), prediction,
                                              pa.array(per_row(np.maximum, depth.astype(np.int32)))], names=[*keep, "listed", "found", "prediction", "depth"])
    return members.select(*keep, *LEAF_ARRAYS).mapInArrow(run, f"{kinds}listed long, found long, prediction double, depth int")


def attribute(df: DataFrame, feature_cols: list[str], keep_cols: list[str], trees, spark,
              out_cols: list[str] | None = None) -> DataFrame:
    """Path attribution for every row, in Arrow batches (``mapInPandas``).

    The packed trees are broadcast once; each task walks its batch through
    all trees with numpy. Output: ``keep_cols`` + prediction, bias and one
    contribution column per name in ``out_cols`` (default: all features).
    """
    out_cols = out_cols or feature_cols
    idx = [feature_cols.index(c) for c in out_cols]
    # Ship this module's helpers with the task (by value), so Python workers
    # need numpy and pandas only, not this package on their path.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    b_trees = spark.sparkContext.broadcast(trees)
    in_schema = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField(c, in_schema[c]) for c in keep_cols]
                          + [T.StructField("prediction", T.DoubleType()), T.StructField("bias", T.DoubleType())]
                          + [T.StructField(f"c_{c}", T.DoubleType()) for c in out_cols])

    def run(batches):
        walk = Walk(b_trees.value, len(feature_cols))
        for pdf in batches:
            X = pdf[feature_cols].to_numpy(dtype=float)
            bias, contrib, pred = path_contributions(X, walk)
            out = pdf[keep_cols].copy()
            out["prediction"] = pred
            out["bias"] = bias
            for j, c in zip(idx, out_cols):
                out[f"c_{c}"] = contrib[:, j]
            yield out

    cols = keep_cols + [c for c in feature_cols if c not in keep_cols]
    return df.select(*cols).mapInPandas(run, schema)
