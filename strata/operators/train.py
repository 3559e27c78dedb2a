"""Training and model selection on MLlib.

The feature pipeline is a ``pyspark.ml.Pipeline`` so cross-validation refits
it inside each fold (no fold leakage). Folds come from the portable
stratified fold column (``splits.stratified_folds``), not from random
partition-dependent splits.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.evaluate import _div0
from strata.operators.forest import FullForest
from strata.operators.trees import CellBoosting, CellForest


@dataclass
class FeatureSchema:
    """Model input columns (the 8-feature schema)."""
    skewed: list[str]       # log1p then scaled
    numeric: list[str]      # scaled
    categorical: list[str]  # one-hot, all levels, unknown -> zeros
    passthrough: list[str]


COHORT_SCHEMA = FeatureSchema(skewed=["fare"], numeric=["age", "family_size"],
                              categorical=["sex", "embarked", "pclass", "title"], passthrough=["has_cabin"])


def feature_stages(schema: FeatureSchema) -> list:
    """F15 + F21 + F22 + F24 as pipeline stages producing ``features``."""
    num = schema.skewed + schema.numeric
    select = ", ".join([f"log1p(CAST({c} AS DOUBLE)) AS _n_{c}" for c in schema.skewed]
                       + [f"CAST({c} AS DOUBLE) AS _n_{c}" for c in schema.numeric]
                       + [f"CAST({c} AS STRING) AS _s_{c}" for c in schema.categorical]
                       + [f"CAST({c} AS DOUBLE) AS _p_{c}" for c in schema.passthrough])
    stages = [SQLTransformer(statement=f"SELECT *, {select} FROM __THIS__"),
              VectorAssembler(inputCols=[f"_n_{c}" for c in num], outputCol="_num", handleInvalid="keep"),
              StandardScaler(inputCol="_num", outputCol="_num_scaled", withMean=True, withStd=True)]
    # one stage for all columns: their levels are counted in one pass
    stages.append(StringIndexer(inputCols=[f"_s_{c}" for c in schema.categorical],
                                outputCols=[f"_i_{c}" for c in schema.categorical], handleInvalid="keep",
                                stringOrderType="alphabetAsc"))
    stages.append(OneHotEncoder(inputCols=[f"_i_{c}" for c in schema.categorical],
                                outputCols=[f"_o_{c}" for c in schema.categorical], dropLast=True,
                                handleInvalid="error"))  # the last is the unknown category: all zeros
    stages.append(VectorAssembler(inputCols=["_num_scaled", *[f"_o_{c}" for c in schema.categorical],
                                             *[f"_p_{c}" for c in schema.passthrough]],
                                  outputCol="features", handleInvalid="keep"))
    return stages


# M4 ---------------------------------------------------------------------------------------
def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weight n / (k * n_c) per row (class counts: one small aggregate)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = counts.crossJoin(tot).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label)  # one row per class


# M1-M3 ------------------------------------------------------------------------------------
def logistic(n_weight_sum: float, C: float = 1.0, l1: bool = False, max_iter: int = 1000) -> LogisticRegression:
    """L2 (or L1) logistic regression with sklearn's C mapped to regParam =
    1 / (C * sum of weights); intercept unpenalised; features already scaled."""
    return LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                              regParam=1.0 / (C * n_weight_sum), elasticNetParam=1.0 if l1 else 0.0,
                              standardization=False, maxIter=max_iter, tol=1e-6)


def forest(num_trees: int = 300, max_depth: int = 12, seed: int = 42, min_instances: int = 1,
           subset: str = "sqrt") -> RandomForestClassifier:
    """Random forest. The reference grows trees without a depth limit; MLlib
    allows at most 30 and keeps every tree on the driver, so fully grown
    trees grow with the data. A depth of 12 (4096 leaves) is the default."""
    return RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                  numTrees=num_trees, maxDepth=max_depth, seed=seed,
                                  minInstancesPerNode=min_instances, featureSubsetStrategy=subset)


def boosting(max_iter: int = 100, step: float = 0.1, max_depth: int = 3, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=max_iter, stepSize=step,
                         maxDepth=max_depth, seed=seed)


def cell_forest(num_trees: int = 300, max_depth: int = 12, seed: int = 42, min_instances: int = 1) -> CellForest:
    """``forest`` (all its parameters) fitted on counted cells: bounded by the bins, not by the rows."""
    return CellForest(num_trees, max_depth, seed, min_instances)


def full_forest(num_trees: int = 300, seed: int = 42, min_instances: int = 1) -> FullForest:
    """The reference's forest: trees grown until a node has one class or nothing to split by, on exact values."""
    return FullForest(num_trees, seed, min_instances)


def cell_boosting(max_iter: int = 100, step: float = 0.1, max_depth: int = 3, seed: int = 42) -> CellBoosting:
    """``boosting`` fitted on counted cells."""
    return CellBoosting(max_iter, step, max_depth, seed)


def make_pipeline(estimator, schema: FeatureSchema = COHORT_SCHEMA) -> Pipeline:
    return Pipeline(stages=[*feature_stages(schema), estimator])


def prepare(df: DataFrame, label: str = "label") -> DataFrame:
    """Label as double and balanced weights."""
    return class_weights(df.withColumn("label", F.col(label).cast("double")), "label")


# E1 on a transformed frame ----------------------------------------------------------------
def f1_of(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    tp = F.count_if((p == 1) & (y == 1))
    fp = F.count_if((p == 1) & (y != 1))
    fn = F.count_if((p != 1) & (y == 1))
    tn = F.count_if((p != 1) & (y != 1))
    return pred.agg(_div0(2 * tp, 2 * tp + fp + fn).alias("f1"), _div0(tp, tp + fp).alias("precision"),
                    _div0(tp, tp + fn).alias("recall"), _div0(tp + tn, F.count(F.lit(1))).alias("accuracy"))


def with_probability(pred: DataFrame) -> DataFrame:
    return pred.withColumn("score", vector_to_array("probability")[1])


# M5 ---------------------------------------------------------------------------------------
def cv_scores(train: DataFrame, make_estimator, fold_col: str = "fold", k: int = 5,
              folds: tuple[int, ...] | None = None) -> dict:
    """Per-fold F1 of the positive class, mean and population std. The whole
    pipeline (features + model) is refitted on each training part. ``folds``
    names the folds to hold out, if not all ``k``. Logistic models of the kind
    ``logistic`` makes are fitted for all folds in one pass a step."""
    from concurrent.futures import ThreadPoolExecutor

    from strata.operators.search import fold_logistic

    which = list(folds or range(k))

    def one(f: int) -> float:
        fit_part = train.where(F.col(fold_col) != f)
        n_w = fit_part.agg(F.sum("weight")).first()[0]
        model = make_pipeline(make_estimator(n_w)).fit(fit_part)
        return f1_of(model.transform(train.where(F.col(fold_col) == f))).first()["f1"]

    est = make_estimator(1.0)
    joint = (isinstance(est, LogisticRegression) and est.getElasticNetParam() == 0 and not est.getStandardization()
             and est.isSet("weightCol") and fold_logistic(train, make_estimator, which, fold_col))
    if joint:
        scores = joint[1]
    else:  # the k fits are independent Spark jobs: submit them concurrently
        with ThreadPoolExecutor(max_workers=k) as pool:
            scores = list(pool.map(one, which))
    mean = sum(scores) / len(scores)
    std = math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores))
    return {"fold_f1": scores, "cv_f1_mean": mean, "cv_f1_std": std}


# M9 / M10 / M11 ---------------------------------------------------------------------------
def evaluate_model(name: str, make_estimator, train: DataFrame, test: DataFrame, n_features: int,
                   cv_folds: tuple[int, ...] | None = None) -> tuple[dict, PipelineModel]:
    """CV F1, train F1, test metrics, AUC, train seconds, predict ms / row.
    ``cv_folds``: the folds held out in turn, all if None; without any the CV
    columns are NULL."""
    from strata.functions.ranks import rank_sum_auc

    res = {"model": name, "n_features": n_features}
    if cv_folds is None or cv_folds:
        res.update({k: v for k, v in cv_scores(train, make_estimator, folds=cv_folds).items() if k != "fold_f1"})
    n_w = train.agg(F.sum("weight")).first()[0]
    t0 = time.time()
    model = make_pipeline(make_estimator(n_w)).fit(train)
    res["train_seconds"] = time.time() - t0
    res["train_f1"] = f1_of(model.transform(train)).first()["f1"]
    t0 = time.time()
    pred = with_probability(model.transform(test)).cache()
    n_test = pred.count()
    res["predict_ms_per_row"] = (time.time() - t0) * 1000 / max(n_test, 1)
    m = f1_of(pred).first()
    res.update({k: m[k] for k in ("accuracy", "precision", "recall", "f1")})
    res["roc_auc"] = rank_sum_auc(pred, "label", "score").first()["auc"]
    pred.unpersist()
    return res, model


RESULT_SCHEMA = ("model string, n_features int, cv_f1_mean double, cv_f1_std double, train_seconds double, "
                 "train_f1 double, predict_ms_per_row double, accuracy double, precision double, recall double, "
                 "f1 double, roc_auc double")


def results_frame(spark, rows: list[dict]) -> DataFrame:
    cols = [c.split()[0] for c in RESULT_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], RESULT_SCHEMA)


# M12 --------------------------------------------------------------------------------------
def overfit_read(results: DataFrame, gap: float = 0.12, floor: float = 0.55) -> DataFrame:
    """Train-test F1 gap > 0.12 Overfitting; train F1 < 0.55 Underfitting; else Stable."""
    g = F.col("train_f1") - F.col("f1")
    return results.select("model", "train_f1", "f1", g.alias("gap"),
                          F.when(g > gap, "Overfitting").when(F.col("train_f1") < floor, "Underfitting")
                          .otherwise("Stable").alias("reading"))


# M6 / M7 / M8 -----------------------------------------------------------------------------
def random_search(train: DataFrame, space: list[dict], make_estimator, n_draws: int, seed: int = 42,
                  parallelism: int = 4) -> DataFrame:
    """Seeded draw of ``n_draws`` parameter sets (all if the space is
    smaller), 5-fold CV F1 each; best = highest mean. Draws are evaluated
    concurrently (``parallelism`` Spark jobs in flight)."""
    import random
    from concurrent.futures import ThreadPoolExecutor

    rnd = random.Random(seed)
    draws = space if n_draws >= len(space) else rnd.sample(space, n_draws)

    def one(params: dict):
        s = cv_scores(train, lambda n_w, p=params: make_estimator(n_w, **p))
        return (str(sorted(params.items())), s["cv_f1_mean"], s["cv_f1_std"])

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = list(pool.map(one, draws))
    spark = train.sparkSession
    return spark.createDataFrame(rows, "params string, cv_f1_mean double, cv_f1_std double")


def select_best(search: DataFrame) -> DataFrame:
    return search.agg(F.max_by("params", F.struct("cv_f1_mean", F.col("params"))).alias("best_params"),
                      F.max("cv_f1_mean").alias("best_cv_f1"))


# X1 ---------------------------------------------------------------------------------------
def coefficients(model: PipelineModel, sample: DataFrame, top: int = 10) -> DataFrame:
    """Coefficient per named transformed feature, top by |coef|, direction."""
    spark = sample.sparkSession
    lr = model.stages[-1]
    feats = model.transform(sample.limit(1)).schema["features"].metadata
    attrs = feats.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in attrs.values():
        for a in group:
            names[a["idx"]] = a["name"]
    coefs = lr.coefficients.toArray().tolist()
    rows = [(names.get(i, f"f{i}"), float(c)) for i, c in enumerate(coefs)]
    df = spark.createDataFrame(rows, "feature string, coef double")
    return (df.withColumn("direction", F.when(F.col("coef") > 0, "raises").otherwise("lowers"))
            .orderBy(F.abs("coef").desc(), "feature").limit(top))
