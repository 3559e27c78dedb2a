"""Scoring and explanation of a linear model.

A linear model is a column expression (intercept + sum of coef x feature),
so Catalyst sees the whole score and keeps it in generated code. The
explanation operators work on the long form ``(id, feature, value)`` joined
to the small coefficient table (one row per model feature: broadcast under
a proven bound).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.ranks import exact_quantiles
from strata.operators.evaluate import _div0
from strata.operators.nearest import nearest
from strata.operators.splits import hash_rank


@dataclass
class LinearModel:
    """Intercept, named coefficients and the design expressions that build
    each feature from raw columns."""
    intercept: float
    coefs: dict[str, float]
    design: dict[str, Column | str]  # Column, or SQL text (built lazily)
    version: str = "given-1"

    @property
    def features(self) -> list[str]:
        return list(self.coefs)

    def feature_expr(self, f: str) -> Column:
        d = self.design[f]
        return F.expr(d).cast("double") if isinstance(d, str) else d

    def matrix(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return df.select(*keep, *[self.feature_expr(f).alias(f) for f in self.features])

    def logit(self) -> Column:
        expr = F.lit(self.intercept)
        for f, c in self.coefs.items():
            expr = expr + F.lit(c) * F.col(f)
        return expr

    def coef_table(self, spark) -> DataFrame:
        return spark.createDataFrame([(f, float(c)) for f, c in self.coefs.items()], "feature string, coef double")


# M15 --------------------------------------------------------------------------------------
def batch_score(matrix: DataFrame, model: LinearModel, key: str, digits: int | None = None,
                version: str | None = None) -> DataFrame:
    """Log-odds, probability (rounded to ``digits`` if given), class (log-odds
    > 0) and model version. ``version``: that of the features of ``matrix``;
    a model of another one is refused before anything is scored."""
    if version is not None and version != model.version:
        raise ValueError(f"the model has version {model.version!r}, the features have {version!r}")
    lo = model.logit()
    p = 1 / (1 + F.exp(-lo))
    return matrix.select(key, lo.alias("log_odds"), (p if digits is None else F.round(p, digits)).alias("probability"),
                         (lo > 0).cast("int").alias("pred"), F.lit(model.version).alias("model_version"))


def _long(matrix: DataFrame, model: LinearModel, key: str) -> DataFrame:
    return matrix.select(key, *model.features).unpivot([key], model.features, "feature", "value")


# X3 / X4 ----------------------------------------------------------------------------------
def row_contributions(matrix: DataFrame, model: LinearModel, key: str) -> DataFrame:
    """contribution = coef x value per (row, feature); log-odds and p per row;
    rank by absolute contribution within the row (ties by feature). Everything
    stays within the row: the terms are one sorted array, then exploded."""
    terms = _terms(model, lambda f: F.col(f).cast("double") * F.lit(float(model.coefs[f])))
    lo = F.lit(model.intercept) + F.aggregate("t", F.lit(0.0), lambda a, x: a + F.coalesce(x["term"], F.lit(0.0)))
    rows = matrix.select(key, F.sort_array(terms).alias("t")).select(key, "t", lo.alias("log_odds"))
    return rows.select(key, "log_odds", F.posexplode("t").alias("pos", "x")).select(
        key, "x.feature", "x.value", F.col("x.term").alias("contribution"), "log_odds",
        (1 / (1 + F.exp(-F.col("log_odds")))).alias("probability"), (F.col("pos") + 1).alias("rank"))


def _terms(model: LinearModel, term) -> Column:
    """Array of (order, feature, value, term) of a row; sorting puts the largest |term| first, ties by feature."""
    return F.array(*[F.struct(F.coalesce(-F.abs(term(f)), F.lit(float("inf"))).alias("order"), F.lit(f).alias("feature"),
                              F.col(f).cast("double").alias("value"), term(f).alias("term")) for f in model.features])


def contribution_strength(matrix: DataFrame, model: LinearModel, key: str, eps: float = 1e-9) -> DataFrame:
    """Active features (|value| > eps), share of the absolute total (%),
    Strong / Moderate / Weak by rank thirds, sign. Computed within the row."""
    terms = _terms(model, lambda f: F.col(f).cast("double") * F.lit(float(model.coefs[f])))
    active = F.filter(F.sort_array(terms), lambda x: F.abs(x["value"]) > eps)
    rows = matrix.select(key, active.alias("t")).select(
        key, F.size("t").alias("n"), F.aggregate("t", F.lit(0.0), lambda a, x: a + F.abs(x["term"])).alias("tot"),
        F.posexplode("t").alias("r", "x"))
    r, n, tot, c = F.col("r"), F.col("n"), F.col("tot"), F.col("x.term")
    return rows.select(
        key, "x.feature", c.alias("contribution"),
        F.when(tot > 0, F.abs(c) / tot * 100).otherwise(F.lit(0.0)).alias("relative_pct"),
        F.when(r < n / 3.0, "Strong").when(r < 2 * n / 3.0, "Moderate").otherwise("Weak").alias("strength"),
        F.when(c > 0, "positive").when(c < 0, "negative").otherwise("zero").alias("direction"))


# X5 ---------------------------------------------------------------------------------------
def linear_shap(matrix: DataFrame, background: DataFrame, model: LinearModel, key: str) -> DataFrame:
    """Exact SHAP of a linear model with an independent background:
    shap = coef x (value - background mean); base = intercept + sum coef x
    mean; running total in order of |shap| (waterfall). All features are
    returned; ``active`` flags non-zero values. Computed within the row;
    ``background`` is the training split, one aggregate; its values are summed
    as decimals of 9 places, so the means do not depend on the order."""
    means = background.agg(*[F.try_divide(F.sum(F.col(f).cast("decimal(28, 9)")).cast("double"), F.count(f))
                             .alias(f"_mean_{f}") for f in model.features])  # one row
    coef = {f: F.lit(float(c)) for f, c in model.coefs.items()}
    base = F.lit(model.intercept) + sum((coef[f] * F.col(f"_mean_{f}") for f in model.features), F.lit(0.0))
    terms = _terms(model, lambda f: coef[f] * (F.col(f).cast("double") - F.col(f"_mean_{f}")))
    rows = matrix.crossJoin(F.broadcast(means)).select(key, base.alias("base"), F.sort_array(terms).alias("t"))
    upto = F.transform("t", lambda x, i: F.struct(x["feature"].alias("feature"), x["value"].alias("value"), x["term"].alias(
        "shap"), (F.col("base") + F.aggregate(F.slice("t", 1, i + 1), F.lit(0.0), lambda a, y: a + F.coalesce(
            y["term"], F.lit(0.0)))).alias("running_total")))
    return rows.select(key, "base", F.explode(upto).alias("x")).select(
        key, "x.feature", "x.value", "x.shap", "base", "x.running_total", (F.abs("x.value") > 1e-9).alias("active"))


# X6 ---------------------------------------------------------------------------------------
def confidence_bands(scores: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Confidence by |p - 0.5| (>= 0.35 High, >= 0.15 Moderate, else Low) and
    decision strength by the tertiles (33.33 %, 66.67 %) of |log-odds| on a
    reference (held-out) set."""
    ref = reference.select(F.abs("log_odds").alias("a"))
    cuts = exact_quantiles(ref, "a", [0.3333, 0.6667]).agg(
        F.max(F.when(F.col("p") == 0.3333, F.col("value"))).alias("weak_cut"),
        F.max(F.when(F.col("p") == 0.6667, F.col("value"))).alias("strong_cut"))
    gap = F.abs(F.col("probability") - 0.5)
    a = F.abs("log_odds")
    return scores.crossJoin(F.broadcast(cuts)).select(  # one row
        key, "probability", "log_odds",
        F.when(gap >= 0.35, "High").when(gap >= 0.15, "Moderate").otherwise("Low").alias("confidence"),
        F.when(a >= F.col("strong_cut"), "Strong").when(a >= F.col("weak_cut"), "Moderate")
        .otherwise("Weak").alias("strength"))


# X7 / X8 ----------------------------------------------------------------------------------
def counterfactuals(raw: DataFrame, model: LinearModel, key: str, candidates: list[tuple[str, str, Column, Column]]
                    ) -> DataFrame:
    """Score every realistic one-column change of every row.

    ``candidates``: (label, column, new value expression, guard) — the guard
    decides whether the variant applies to a row. Variants are built as one
    explode over a bounded array of structs per row (no join), scored in the
    same projection, and compared with the original score.
    """
    lo = model.logit()
    base = model.matrix(raw, [key] + [c for c in raw.columns if c != key]).select(
        key, *[c for c in raw.columns if c != key], (1 / (1 + F.exp(-lo))).alias("_p0"), (lo > 0).alias("_y0"))
    cols = [c for c in raw.columns if c != key]
    variants = []
    for label, column, value, guard in candidates:
        fields = [(value if c == column else F.col(c)).cast(raw.schema[c].dataType).alias(c) for c in cols]
        variants.append(F.when(guard, F.struct(F.lit(label).alias("_change"),
                                                value.cast("string").alias("_new_value"), *fields)))
    ex = base.select(key, "_p0", "_y0", F.explode(F.array_compact(F.array(*variants))).alias("v")).select(
        key, "_p0", "_y0", "v.*")
    scored = model.matrix(ex, [key, "_p0", "_y0", "_change", "_new_value"])
    lo2 = model.logit()
    p1 = 1 / (1 + F.exp(-lo2))
    return scored.select(key, F.col("_change").alias("change"), F.col("_new_value").alias("new_value"),
                         F.col("_p0").alias("probability"), p1.alias("new_probability"),
                         (p1 - F.col("_p0")).alias("difference"), ((lo2 > 0) != F.col("_y0")).alias("flips"))


def prediction_stability(cf: DataFrame, key: str) -> DataFrame:
    """Per row: largest absolute change, smallest flipping change (if any),
    label: any flip -> Unstable; >= 0.15 Moderately Stable; >= 0.05 Stable;
    else Very Stable."""
    a = F.abs("difference")
    agg = cf.groupBy(key).agg(
        F.max(a).alias("max_swing"), F.bool_or("flips").alias("any_flip"),
        F.min_by(F.col("change"), F.when(F.col("flips"), F.struct(a, F.col("change")))).alias("smallest_flip"))
    return agg.withColumn(
        "stability", F.when(F.col("any_flip"), "Unstable").when(F.col("max_swing") >= 0.15, "Moderately Stable")
        .when(F.col("max_swing") >= 0.05, "Stable").otherwise("Very Stable"))


def feature_sensitivity(cf: DataFrame, key: str) -> DataFrame:
    """Per (row, changed column) the largest absolute probability change."""
    return (cf.withColumn("column", F.split("change", ":")[0]).groupBy(key, "column")
            .agg(F.max(F.abs("difference")).alias("max_abs_difference")))


# X9 ---------------------------------------------------------------------------------------
def nearest_rows(queries: DataFrame, history: DataFrame, key: str, features: list[str], k: int = 3) -> DataFrame:
    """``nearest`` over the given feature columns, with the similarity 100 / (1 + d)."""
    of = lambda df: df.select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("_v"))
    return nearest(of(queries), of(history), key, "_v", k).withColumn("similarity", 100 / (1 + F.col("distance")))


# X2 / R5 ----------------------------------------------------------------------------------
def permutation_importance(raw: DataFrame, model: LinearModel, key: str, label: str, columns: list[str],
                           repeats: int = 30, seed: int = 42) -> DataFrame:
    """Mean F1 drop when one raw column is permuted across rows, over
    ``repeats`` permutations.

    The rows are put in a random order once (by the hash of their key, ranked
    by distributed prefix sums); permutation r gives each row the value of the row
    ``1 + r * (n - 1) div repeats`` places further on, cyclically: a bijection,
    different for each r while n > repeats. All columns share the
    permutations, so a repeat shuffles each row once; the columns are tried
    one by one after the join, within the row.
    """
    from strata.functions.ranks import materialize

    rows = materialize(hash_rank(raw, key, seed=seed, out_col="_i").withColumn("_i", F.col("_i") - 1))
    n = rows.agg(F.count(F.lit(1)).alias("_n"))  # one row
    lo = model.logit()
    base_pred = model.matrix(rows, [key, label]).select(key, label, (lo > 0).cast("int").alias("_pred"))
    base_f1 = base_pred.agg(_div0(2 * F.count_if((F.col("_pred") == 1) & (F.col(label) == 1)),
                                  2 * F.count_if((F.col("_pred") == 1) & (F.col(label) == 1))
                                  + F.count_if((F.col("_pred") == 1) & (F.col(label) != 1))
                                  + F.count_if((F.col("_pred") != 1) & (F.col(label) == 1))).alias("base_f1"))
    donors = rows.select(F.col("_i").alias("_j"), *[F.col(c).alias(f"_d_{c}") for c in columns])
    out = (rows.crossJoin(F.broadcast(n))
           .withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
           .withColumn("_j", F.expr(f"(_i + 1 + (rep * (_n - 1)) div {int(repeats)}) % _n"))
           .join(donors, "_j")
           .withColumn("column", F.explode(F.array(*[F.lit(c) for c in columns]))))
    for c in columns:
        out = out.withColumn(c, F.when(F.col("column") == c, F.col(f"_d_{c}")).otherwise(F.col(c)))
    m = model.matrix(out, [key, label, "column", "rep"])
    pred = (model.logit() > 0).cast("int")
    f1 = m.withColumn("_pred", pred).groupBy("column", "rep").agg(
        F.count_if((F.col("_pred") == 1) & (F.col(label) == 1)).alias("tp"),
        F.count_if((F.col("_pred") == 1) & (F.col(label) != 1)).alias("fp"),
        F.count_if((F.col("_pred") != 1) & (F.col(label) == 1)).alias("fn"))
    f1 = f1.withColumn("f1", _div0(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))
    return (f1.crossJoin(F.broadcast(base_f1)).groupBy("column")
            .agg(F.avg(F.col("base_f1") - F.col("f1")).alias("importance"),
                 F.stddev_pop(F.col("base_f1") - F.col("f1")).alias("importance_std")))
