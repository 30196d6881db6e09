"""Area clustering / components and the property uplift model.

Area level (one row per area): feature table = priority ⟕ wall split, with
features share below target, income deprivation and share of solid-wall
recommendations; standardised with the population std; PCA with PC1
oriented so the top-priority area scores positive; k-means sweep and
best-of-seeds k = 4 tiers relabelled by mean PC1; bisecting k-means tiers
(the divisive stand-in for the reference's Ward tree); method agreement.

Property level: encoded property features + multi-hot of frequent
recommendation types -> random forest of the assessed uplift; path
attribution of every property's prediction; the attribution stratified by
age group feeds the same greedy cover as the SQL-checked estimate.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..operators import ml, ward
from ..operators.ranking import rank_desc
from ..operators.stats import standardise
from ..session import durable, scratch_path
from ..sources.readers import _fs
from . import gold, layers, reach, retrofit
from .layers import _fingerprint

AREA_FEATURES = ["pct_below_epc_c", "income_deprivation_rate", "pct_solid_wall"]
Z = [f"{c}_z" for c in AREA_FEATURES]
# fixed values: tier labels in order of mean PC1, highest first
TIER_LABELS = ("Act now", "Act next", "Monitor", "Deprioritise")


def area_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority ⟕ wall split (J4), rows with any missing feature dropped."""
    silver = layers.homes(spark, sf_dir)
    pr = gold.composite_priority(spark, sf_dir, silver)
    wall = retrofit.wall_split(layers.retrofit_rollup(spark, sf_dir)).select("borough", "pct_solid_wall")
    return pr.join(wall, "borough", "left").na.drop(subset=AREA_FEATURES)


def area_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise(area_features(spark, sf_dir), AREA_FEATURES)


def area_components(spark: SparkSession, sf_dir: str):
    """(scored areas with pc1..pc3 and pca_rank, loadings, explained variance)."""
    scaled = durable(area_scaled(spark, sf_dir))
    anchor_name = scaled.orderBy("priority_rank", "borough").select("borough").first()[0]
    scored, loadings, var = ml.pca(scaled, Z, 3, anchor=F.col("borough") == anchor_name)
    scored = rank_desc(scored, "pc1", "pca_rank")
    return scored.withColumn("rank_shift", F.col("pca_rank") - F.col("priority_rank")), loadings, var


def pca_rank(spark, sf_dir) -> DataFrame:
    scored, _, _ = area_components(spark, sf_dir)
    return (scored.select("borough", "priority_rank", "pca_rank", "rank_shift", "pc1", "pc2", *AREA_FEATURES)
            .orderBy(F.abs("rank_shift").desc(), "borough"))


def pca_components(spark, sf_dir) -> DataFrame:
    _, loadings, var = area_components(spark, sf_dir)
    rows = [(f"PC{i + 1}", var[i], *[row[1 + i] for row in loadings]) for i in range(len(var))]
    return spark.createDataFrame(rows, ["component", "explained_variance", *[f"loading_{c}" for c in AREA_FEATURES]])


def _with_vector(scored: DataFrame) -> DataFrame:
    return ml.assemble(scored, Z, "zf")


def sweep_table(spark, sf_dir) -> tuple[DataFrame, list[tuple]]:
    """(areas x k with cluster, distance and silhouette, written once; the models' own (k, inertia))."""
    scored = durable(area_components(spark, sf_dir)[0])   # read in every round
    long, costs = ml.kmeans_assignments(scored, "borough", Z)
    return durable(ml.pairwise_silhouettes(long, Z, "cluster", "k")), costs


def kmeans_sweep(spark, sf_dir) -> DataFrame:
    """(k, inertia, silhouette) of the best of ten seeded models for each k, silhouettes by Euclidean distance (M6)."""
    long, _ = sweep_table(spark, sf_dir)
    return long.groupBy("k").agg(F.sum("distance").alias("inertia"), F.avg("silhouette").alias("silhouette"))


def kmeans_tiers(spark, sf_dir, scored: DataFrame | None = None) -> DataFrame:
    scored = durable(scored if scored is not None else area_components(spark, sf_dir)[0])
    labelled = ml.relabel_by(durable(ml.kmeans_best(scored, Z, 4)), "cluster", "pc1", "kmeans_tier_id")
    tiers = F.create_map(*[F.lit(x) for i, t in enumerate(TIER_LABELS) for x in (i, t)])
    labelled = labelled.withColumn("kmeans_tier", tiers[F.col("kmeans_tier_id")])
    return ml.silhouette_rows(labelled, Z, "kmeans_tier_id")


def cluster_profile(spark, sf_dir) -> DataFrame:
    """Members and feature means per tier (M9); member lists are bounded by the area count."""
    t = kmeans_tiers(spark, sf_dir)
    return t.groupBy("kmeans_tier_id", "kmeans_tier").agg(
        F.count(F.lit(1)).alias("members"), F.sort_array(F.collect_list("borough")).alias("areas"),
        *[F.round(F.avg(c), 4).alias(f"avg_{c}") for c in AREA_FEATURES],
        F.round(F.avg("silhouette"), 4).alias("avg_silhouette"))


def bisecting_tiers(spark, sf_dir, scored: DataFrame | None = None) -> DataFrame:
    scored = scored if scored is not None else area_components(spark, sf_dir)[0]
    feat = durable(_with_vector(scored))
    out = feat
    for k in (3, 4):
        m = ml.bisecting(feat, "zf", k)
        lab = ml.relabel_by(m.transform(feat).select("borough", "cluster", "pc1"), "cluster", "pc1", f"hc_{k}")
        out = out.join(lab.select("borough", f"hc_{k}"), "borough")
    return out.select("borough", "priority_rank", "pc1", "hc_3", "hc_4")


def ward_linkage(spark, sf_dir) -> DataFrame:
    """Ward's merges of the areas (M10): step, the two clusters, height and size; areas are leaves in order of their features."""
    _, _, made = ward.linkage(area_scaled(spark, sf_dir), Z)
    return spark.createDataFrame([(i + 1, a, b, height, int(n)) for i, (a, b, height, n) in enumerate(made)],
                                 "step int, one int, other int, height double, n_areas long")


def ward_tiers(spark, sf_dir) -> DataFrame:
    """Areas with their Ward clusters for 3 and 4 tiers, numbered by mean PC1, highest first."""
    scored = durable(area_components(spark, sf_dir)[0])
    found = ward.linkage(scored, Z)
    out = scored
    for k in (3, 4):
        labelled = ward.with_clusters(scored.select("borough", "pc1", *Z), Z, k, "cluster", found)
        out = out.join(ml.relabel_by(labelled, "cluster", "pc1", f"ward_{k}").select("borough", f"ward_{k}"), "borough")
    return out.select("borough", "priority_rank", "pc1", "ward_3", "ward_4")


def method_agreement(spark, sf_dir) -> DataFrame:
    """Side-by-side methods and top-group agreement."""
    scored = durable(area_components(spark, sf_dir)[0])
    km = kmeans_tiers(spark, sf_dir, scored).select("borough", "kmeans_tier", "kmeans_tier_id")
    hc = bisecting_tiers(spark, sf_dir, scored).select("borough", "hc_4")
    t = (scored.select("borough", "priority_rank", "pca_rank", "rank_shift", *AREA_FEATURES)
         .join(km, "borough").join(hc, "borough"))
    flags = {"top5_original": F.col("priority_rank") <= fixed.TOP_AREAS,
             "top5_pca": F.col("pca_rank") <= fixed.TOP_AREAS,
             "top_kmeans": F.col("kmeans_tier_id") == 0, "top_hc": F.col("hc_4") == 0}
    for k, v in flags.items():
        t = t.withColumn(k, v)
    return t.withColumn("agreed_all", F.col("top5_original") & F.col("top5_pca") & F.col("top_kmeans")
                        & F.col("top_hc")).withColumnRenamed("hc_4", "hc_cluster")


def corr_matrix(spark, sf_dir) -> DataFrame:
    from ..operators.stats import corr_matrix as cm
    a = area_features(spark, sf_dir)
    pairs = cm(a, AREA_FEATURES)
    old = a.agg(F.lit("pct_below_epc_c").alias("x"), F.lit("pct_pre_1950").alias("y"),
                F.corr("pct_below_epc_c", "pct_pre_1950").alias("r"))
    return pairs.unionByName(old).withColumn("r", F.round("r", 6))


def regression_line(spark, sf_dir) -> DataFrame:
    from ..operators.stats import regression_line as rl
    out = rl(area_features(spark, sf_dir), "pct_below_epc_c", "pct_solid_wall")
    return out.select(*[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r")], "n")


def standardised(spark, sf_dir) -> DataFrame:
    s = area_scaled(spark, sf_dir)
    return s.select("borough", *[F.round(c, 6).alias(c) for c in Z])


# ------------------------------------------------------------------ property model

def type_column(i: int) -> str:
    """Feature column of the i-th frequent type."""
    return f"has_type_{i}"


def frequent_type_names(recs: DataFrame, min_freq: int = fixed.MIN_TYPE_FREQ) -> list[str]:
    """The frequent types, most frequent first; bounded by the type vocabulary."""
    ft = reach.frequent_types(recs, min_freq).orderBy(F.desc("n_rows"), F.asc("improvement_type"))
    return [r[0] for r in ft.select("improvement_type").collect()]


def multi_hot(recs: DataFrame, types: list[str]) -> DataFrame:
    """Certificate x frequent type presence, 1/0 (A38), pivoted over the known type list."""
    names = [type_column(i) for i in range(len(types))]
    wide = (recs.filter(F.col("improvement_type").isin(*types))
            .groupBy("certificate_id").pivot("improvement_type", types).agg(F.max(F.lit(1).cast("long"))))
    # pivot output columns follow the given value order; rename positionally
    return wide.toDF("certificate_id", *names).na.fill(0, subset=names)


def ml_table(spark: SparkSession, sf_dir: str, min_freq: int = fixed.MIN_TYPE_FREQ):
    """(feature table, property feature names, rec feature names)."""
    silver = layers.homes(spark, sf_dir)
    recs = layers.recommended(spark, sf_dir)
    types = frequent_type_names(recs, min_freq)
    rec_cols = [type_column(i) for i in range(len(types))]
    certs = (silver.filter(F.col("epc_score").isNotNull() & F.col("epc_potential").isNotNull())
             .withColumn("uplift", F.col("epc_potential") - F.col("epc_score"))
             .filter(F.col("uplift") >= 0)
             .select("certificate_id", "borough", "epc_score", "uplift",
                     F.coalesce("construction_age_band", F.lit(fixed.UNKNOWN)).alias("age_band"),
                     F.coalesce("property_type", F.lit(fixed.UNKNOWN)).alias("prop_type"),
                     C.age_group("construction_age_band").alias("age_group")))
    enc = StringIndexer(inputCols=["age_band", "prop_type"], outputCols=["age_band_enc", "prop_type_enc"],
                        stringOrderType="alphabetAsc", handleInvalid="keep").fit(certs)
    # plain ordinal codes: with the encoder's nominal metadata the forest would split on categories
    coded = enc.transform(certs).withMetadata("age_band_enc", {}).withMetadata("prop_type_enc", {})
    table = coded.join(multi_hot(recs, types), "certificate_id", "left").na.fill(0, subset=rec_cols)
    prop_cols = ["epc_score", "age_band_enc", "prop_type_enc"]
    return table, prop_cols, rec_cols, types


def split(df: DataFrame):
    """Deterministic 80/20 split by a digest of the id (M14): stable across runs, executors and engines."""
    fold = F.conv(F.substring(F.md5(F.col("certificate_id").cast("binary")), 1, 6), 16, 10).cast("long") % 5
    return df.filter(fold != 0), df.filter(fold == 0)


def trained_forest(spark: SparkSession, sf_dir: str):
    """(model, assembled table, feature names, rec names, types, path); the model is cached per input snapshot."""
    table, prop_cols, rec_cols, types = ml_table(spark, sf_dir)
    feats = prop_cols + rec_cols
    data = durable(ml.assemble(table, feats, "features"))
    # keyed by the input snapshot and the feature list, so a model is never reused for other features
    path = scratch_path(spark, f"models/{_fingerprint(spark, sf_dir, 'forest|' + ','.join(feats))}")
    fs, saved = _fs(spark, f"{path}/data/_SUCCESS")   # written last
    if fs.exists(saved):
        model = RandomForestRegressionModel.load(path)
    else:
        train, _ = split(data)
        model = ml.fit_forest(ml.even_parts(train.select("features", "uplift")), "features", "uplift")
        model.write().overwrite().save(path)
    return model, data, feats, rec_cols, types, path


def uplift_model_metrics(spark, sf_dir) -> DataFrame:
    """MAE, R², share within ±5 points and mean-predictor MAE on the held-out fold (M16), one pass."""
    model, data, *_ = trained_forest(spark, sf_dir)
    train, test = split(data)
    mean_train = train.agg(F.avg("uplift")).first()[0]
    pred = model.transform(test)
    err = F.col("prediction") - F.col("uplift")
    n = F.count(F.lit(1))
    return pred.agg(
        n.alias("n_test"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.sum(err * err) / (F.var_pop("uplift") * n)).alias("r2"),
        F.round(F.count_if(F.abs(err) <= 5) / n * 100, 1).alias("pct_within_5"),
        F.avg(F.abs(F.col("uplift") - F.lit(mean_train))).alias("baseline_mae"),
    )


def path_attribution(spark, sf_dir, forest: tuple | None = None) -> DataFrame:
    """Per-property path attribution of the forest's prediction, all properties (M17); ``forest`` is a ``trained_forest`` at hand."""
    model, data, feats, rec_cols, _, path = forest or trained_forest(spark, sf_dir)
    trees = ml._pack(ml.forest_nodes(model, spark, path))
    return ml.attribute(data, feats, ["certificate_id", "borough", "age_group", *rec_cols], trees, spark,
                        out_cols=rec_cols)


def attribution_check(spark, sf_dir) -> DataFrame:
    """Rows, rows whose bias and contributions miss the prediction, rows whose prediction misses the forest's own."""
    model, data, feats, _, _, path = trained_forest(spark, sf_dir)
    trees = ml._pack(ml.forest_nodes(model, spark, path))
    own = model.transform(data).select("certificate_id", *feats, F.col("prediction").alias("own"))
    att = ml.attribute(own, feats, ["certificate_id", "own"], trees, spark)
    total = F.col("bias") + sum((F.col(f"c_{c}") for c in feats[1:]), F.col(f"c_{feats[0]}"))
    wrong = lambda x, y: F.count_if(F.abs(x - y) > 1e-6)
    return att.agg(F.count(F.lit(1)).alias("n_rows"), wrong(total, F.col("prediction")).alias("n_not_additive"),
                   wrong(F.col("own"), F.col("prediction")).alias("n_not_the_forest"))


def model_attribution_long(spark, sf_dir, forest: tuple | None = None, att: DataFrame | None = None) -> DataFrame:
    """(improvement_type, age_group, avg_pts, overall_avg_pts, n_present) from the forest attribution.

    For each frequent type: mean contribution over properties where it is
    present, by age group and overall, rounded to 2 dp; types present on
    fewer than 30 properties are dropped (A40, M18). ``forest`` and ``att`` are a ``trained_forest`` and its ``path_attribution`` at hand.
    """
    forest = forest or trained_forest(spark, sf_dir)
    model, data, feats, rec_cols, types, _ = forest
    if not types:   # no type is frequent enough
        return spark.createDataFrame([], "improvement_type string, age_group string, avg_pts double, overall_avg_pts double, n_present long")
    att = path_attribution(spark, sf_dir, forest) if att is None else att
    long = att.select("certificate_id", "age_group", F.explode(F.array(*[
        F.struct(F.lit(t).alias("improvement_type"), F.col(c).alias("present"), F.col(f"c_{c}").alias("contrib"))
        for t, c in zip(types, rec_cols)])).alias("e")).select("age_group", "e.*").filter(F.col("present") == 1)
    by_age = long.groupBy("improvement_type", "age_group").agg(F.sum("contrib").alias("s"),
                                                                F.count(F.lit(1)).alias("c"))
    overall = by_age.groupBy("improvement_type").agg(
        F.round(F.sum("s") / F.sum("c"), 2).alias("overall_avg_pts"),
        F.sum("c").alias("n_present")).filter(F.col("n_present") >= fixed.MIN_PRESENT_ROWS)
    return durable(by_age.join(overall, "improvement_type").select(
        "improvement_type", "age_group", F.round(F.col("s") / F.col("c"), 2).alias("avg_pts"),
        "overall_avg_pts", "n_present"))


def attribution_by_age_model(spark, sf_dir) -> DataFrame:
    recs = layers.retrofit_base(spark, sf_dir)
    return reach.attribution_table(model_attribution_long(spark, sf_dir), recs)


def greedy_model_summary(spark, sf_dir, results: DataFrame | None = None) -> DataFrame:
    """The greedy cover driven by the model attribution, summarised per area (M19 -> A44); ``results`` are its ``greedy_results`` at hand."""
    silver = layers.homes(spark, sf_dir)
    if results is None:
        recs = layers.retrofit_base(spark, sf_dir)
        results = reach.greedy_results(reach.greedy_rows(recs, model_attribution_long(spark, sf_dir)))
    props = durable(reach.property_classes(silver, results))
    return reach.area_greedy_summary(silver, props)
