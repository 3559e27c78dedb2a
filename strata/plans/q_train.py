"""Training, model comparison and promotion queries."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from strata.functions.ranks import materialize, rank_sum_auc
from strata.operators import features as FT
from strata.operators import search as SE
from strata.operators import splits as S
from strata.operators import train as M
from strata.plans.catalog import register
from strata.plans.fixtures import cohort, oracle_with, scored
from strata.plans.q_splits import split_cte
from strata.session import shared_dir

FEATURES_8 = ["pclass", "sex", "age", "fare", "embarked", "has_cabin", "family_size", "title"]
N_FEATURES = 8


_FRAMES: dict = {}


def model_frame(spark, sf):
    """Cohort -> split -> features fitted on the training split -> weights,
    plus stratified fold ids on the training rows. Written once per session
    and input folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key in _FRAMES:
        return _FRAMES[key]
    out = _model_frame(spark, sf)
    _FRAMES[key] = out
    return out


def _model_frame(spark, sf):
    df = cohort(spark, sf)
    sp = materialize(S.stratified_split(df, "id", "label"))  # fit, contract checks and transform read it
    train_raw = sp.where(F.col("split") == "train")
    fitted = FT.CohortFeatures().fit(train_raw)
    t = fitted.transform(sp).select("id", "label", "split", *FEATURES_8)
    t = materialize(M.prepare(t))
    train = materialize(S.stratified_folds(t.where(F.col("split") == "train"), "id", "label", 5))
    return train, t.where(F.col("split") == "test")


def lr_est(n_w, C=1.0, l1=False):
    return M.logistic(n_w, C=C, l1=l1)


def rf_est(n_w):
    return M.full_forest()


def gbt_est(n_w):
    return M.cell_boosting()


@register("class_weights", oracle_with("cohort") + """
SELECT label, count(*) AS n, (SELECT count(*) FROM cohort) / (2.0 * count(*)) AS weight FROM cohort GROUP BY label
""")
def q_class_weights(spark, sf):
    w = M.class_weights(cohort(spark, sf).select("label"), "label")
    return w.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.first("weight").alias("weight"))


@register("train_logreg")
def q_train_logreg(spark, sf):
    """M1 + M9: logistic regression (L2, C=1, balanced) on the 8 features."""
    train, test = model_frame(spark, sf)
    res, _ = M.evaluate_model("logistic", lr_est, train, test, N_FEATURES)
    return M.results_frame(spark, [res])


@register("train_rf")
def q_train_rf(spark, sf):
    """M2: random forest, 300 trees of any depth, balanced (no CV here; see compare_models)."""
    train, test = model_frame(spark, sf)
    res, _ = M.evaluate_model("random_forest", rf_est, train, test, N_FEATURES, cv_folds=())
    return M.results_frame(spark, [res])


@register("train_gbt")
def q_train_gbt(spark, sf):
    """M3: gradient boosting, 100 rounds, rate 0.1, depth 3."""
    train, test = model_frame(spark, sf)
    res, _ = M.evaluate_model("gradient_boosting", gbt_est, train, test, N_FEATURES, cv_folds=())
    return M.results_frame(spark, [res])


@register("cv_scores")
def q_cv_scores(spark, sf):
    """M5: per-fold F1 of the logistic model, mean and population std."""
    train, _ = model_frame(spark, sf)
    s = M.cv_scores(train, lr_est)
    return spark.createDataFrame([(i, f, s["cv_f1_mean"], s["cv_f1_std"]) for i, f in enumerate(s["fold_f1"])],
                                 "fold int, f1 double, cv_f1_mean double, cv_f1_std double")


# The search spaces of the two tuned models.
LOGREG_SPACE = [{"C": c, "l1": l1} for c in (0.001, 0.01, 0.1, 1.0, 10.0, 100.0) for l1 in (False, True)]
RF_SPACE = [{"num_trees": t, "max_depth": d, "min_instances": m}
            for t in (100, 200, 300, 400) for d in (4, 6, 8, 10, None) for m in (1, 2, 4)
            for _split in (2, 5, 10)]  # min_samples_split has no MLlib counterpart: draws repeat


def rf_search_est(n_w, num_trees=300, max_depth=None, min_instances=1):
    return M.forest(num_trees=num_trees, max_depth=30 if max_depth is None else max_depth,
                    min_instances=min_instances)


def q_tune_rf(spark, sf):
    """M6 + M8: 20 seeded draws of the forest space, 5-fold CV F1 each
    (not registered: 100 forest fits)."""
    train, _ = model_frame(spark, sf)
    search = M.random_search(train, RF_SPACE, rf_search_est, n_draws=20)
    return search.crossJoin(M.select_best(search))


_TUNED: dict = {}


def tuned_logistic(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TUNED:  # the fitted coefficients alone are kept
        _TUNED[key] = SE.tune_logistic(model_frame(spark, sf)[0], LOGREG_SPACE)
    return _TUNED[key]


@register("tune_logreg")
def q_tune_logreg(spark, sf):
    """M7: the whole 6 x 2 space (C x penalty), F1 of five folds each, best set selected (rows-only)."""
    return tuned_logistic(spark, sf)[0]


@register("tuned_scores")
def q_tuned_scores(spark, sf):
    """Held-out probabilities of the tuned logistic model, fitted on all training rows (rows-only)."""
    _, _, model, pipeline = tuned_logistic(spark, sf)
    return SE.score(model_frame(spark, sf)[1].select("id", "label", *FEATURES_8), model, pipeline).select(
        "id", F.col("label").cast("int").alias("label"), "score")


@register("compare_models")
def q_compare_models(spark, sf):
    """M9 + M10 + M8: logistic, forest and boosting under one split; the best
    mean F1 over the same five folds is selected."""
    train, test = model_frame(spark, sf)
    rows = [M.evaluate_model(n, e, train, test, N_FEATURES)[0]
            for n, e in (("logistic", lr_est), ("random_forest", rf_est), ("gradient_boosting", gbt_est))]
    res = M.results_frame(spark, rows)
    return res.withColumn("selected", F.col("model") == res.agg(
        F.max_by("model", F.struct("cv_f1_mean", "f1"))).first()[0])


@register("holdout_scores")
def q_holdout_scores(spark, sf):
    """Held-out probabilities of every model on identical rows (long)."""
    train, test = model_frame(spark, sf)
    parts = []
    for name, est in (("logistic", lr_est), ("random_forest", rf_est), ("gradient_boosting", gbt_est)):
        n_w = train.agg(F.sum("weight")).first()[0]
        model = M.make_pipeline(est(n_w)).fit(train)
        parts.append(M.with_probability(model.transform(test)).select(
            F.lit(name).alias("model"), "id", F.col("label").cast("int").alias("label"), "score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


TRAIN_IDS = "id IN (SELECT _key FROM split WHERE split = 'train')"


@register("overfit_read", oracle_with("scored") + split_cte("scored") + f""",
p AS (SELECT id, label, CAST(score >= 0.5 AS INT) AS pa, CAST(score_b >= 0.5 AS INT) AS pb,
             {TRAIN_IDS} AS is_train FROM scored),
f AS (SELECT 'model_a' AS model, is_train, count(*) FILTER (WHERE pa = 1 AND label = 1) AS tp,
             count(*) FILTER (WHERE pa = 1 AND label = 0) AS fp, count(*) FILTER (WHERE pa = 0 AND label = 1) AS fn
      FROM p GROUP BY is_train
      UNION ALL
      SELECT 'model_b', is_train, count(*) FILTER (WHERE pb = 1 AND label = 1),
             count(*) FILTER (WHERE pb = 1 AND label = 0), count(*) FILTER (WHERE pb = 0 AND label = 1)
      FROM p GROUP BY is_train),
g AS (SELECT model, max(CASE WHEN is_train THEN 2.0 * tp / (2 * tp + fp + fn) END) AS train_f1,
             max(CASE WHEN NOT is_train THEN 2.0 * tp / (2 * tp + fp + fn) END) AS f1 FROM f GROUP BY model)
SELECT model, train_f1, f1, train_f1 - f1 AS gap,
       CASE WHEN train_f1 - f1 > 0.12 THEN 'Overfitting' WHEN train_f1 < 0.55 THEN 'Underfitting'
            ELSE 'Stable' END AS reading
FROM g
""")
def q_overfit_read(spark, sf):
    """M12 on the two fixture models: train vs test F1 and the reading."""
    sp = S.stratified_split(scored(spark, sf), "id", "label")
    rows = []
    for name, col in (("model_a", "score"), ("model_b", "score_b")):
        d = sp.withColumn("prediction", (F.col(col) >= 0.5).cast("int"))
        tr = M.f1_of(d.where(F.col("split") == "train")).select(F.col("f1").alias("train_f1"))
        te = M.f1_of(d.where(F.col("split") == "test")).select("f1")
        rows.append(tr.crossJoin(te).select(F.lit(name).alias("model"), "train_f1", "f1"))
    return M.overfit_read(rows[0].unionByName(rows[1]))


@register("train_promote")
def q_train_promote(spark, sf):
    """M14 + S5: retrain the chosen model, save it under a new version in the
    shared folder, load it back and re-report test metrics."""
    train, test = model_frame(spark, sf)
    n_w = train.agg(F.sum("weight")).first()[0]
    model = M.make_pipeline(lr_est(n_w)).fit(train)
    version = "v2"
    path = shared_dir(spark, f"models-{uuid.uuid4().hex}/model/version={version}")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    pred = M.with_probability(loaded.transform(test))
    auc = rank_sum_auc(pred, "label", "score").select(F.col("auc").alias("roc_auc"))
    return M.f1_of(pred).crossJoin(auc).withColumn("model_version", F.lit(version))


@register("score_trained")
def q_score_trained(spark, sf):
    """M15 with a trained MLlib pipeline: probability, class, version, all rows."""
    train, test = model_frame(spark, sf)
    n_w = train.agg(F.sum("weight")).first()[0]
    model = M.make_pipeline(lr_est(n_w)).fit(train)
    every = train.drop("fold").unionByName(test)
    return M.with_probability(model.transform(every)).select(
        "id", "score", F.col("prediction").cast("int").alias("pred"), F.lit("v2").alias("model_version"))


@register("coefficients")
def q_coefficients(spark, sf):
    """Top 10 coefficients of the logistic model with feature names."""
    train, _ = model_frame(spark, sf)
    n_w = train.agg(F.sum("weight")).first()[0]
    model = M.make_pipeline(lr_est(n_w)).fit(train)
    return M.coefficients(model, train)


@register("select_model")
def q_select_model(spark, sf):
    """M8: the tuned logistic model against the untuned, balanced one, by mean F1 over the same five folds; the
    highest is selected (rows-only)."""
    train, _ = model_frame(spark, sf)
    tuned = tuned_logistic(spark, sf)[0].where("selected").first()
    rows = [("logistic_tuned", f"C={tuned['C']}, l1={tuned['l1']}", tuned["cv_f1_mean"], tuned["cv_f1_std"])]
    s = M.cv_scores(train, lr_est)
    rows.append(("logistic", "C=1.0, l1=False, balanced", s["cv_f1_mean"], s["cv_f1_std"]))
    best = max(rows, key=lambda r: r[2])[0]
    return spark.createDataFrame([(*r, r[0] == best) for r in rows],
                                 "model string, params string, cv_f1_mean double, cv_f1_std double, selected boolean")
