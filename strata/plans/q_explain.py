"""Scoring and explanation queries with a given linear model."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from strata.operators import explain as X
from strata.operators import profile as P
from strata.operators import splits as S
from strata.operators.nearest import nearest
from strata.plans.catalog import register
from strata.plans.fixtures import cohort, oracle_with
from strata.plans.q_splits import split_cte

# A given logistic model over the cohort (so scoring and
# explanation are checkable without training). Design expressions are SQL
# text understood by Spark and DuckDB alike.
INTERCEPT = -1.2
COEFS = [("sex_female", 2.1), ("pclass_1", 0.9), ("pclass_2", 0.45), ("age_10", -0.25),
         ("fare_k", 0.3), ("family_size", -0.12), ("has_cabin", 0.5), ("embarked_C", 0.2)]
DESIGN = {
    "sex_female": "CASE WHEN sex = 'female' THEN 1 ELSE 0 END",
    "pclass_1": "CASE WHEN pclass = 1 THEN 1 ELSE 0 END",
    "pclass_2": "CASE WHEN pclass = 2 THEN 1 ELSE 0 END",
    "age_10": "COALESCE(age, CAST(30 AS DOUBLE)) / 10",
    "fare_k": "fare / 100000",
    "family_size": "sibsp + parch + 1",
    "has_cabin": "CASE WHEN cabin IS NOT NULL THEN 1 ELSE 0 END",
    "embarked_C": "CASE WHEN embarked = 'C' THEN 1 ELSE 0 END",
}
RAW = ["id", "label", "pclass", "sex", "age", "sibsp", "parch", "fare", "cabin", "embarked"]

MODEL = X.LinearModel(INTERCEPT, dict(COEFS), dict(DESIGN))


def _lit(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


MATRIX_SQL = ", ".join(f"CAST({DESIGN[f]} AS DOUBLE) AS {f}" for f, _ in COEFS)
LOGIT_SQL = _lit(INTERCEPT) + "".join(f" + {_lit(c)} * {f}" for f, c in COEFS)

C = oracle_with("cohort") + f""",
mx AS (SELECT id, label, {MATRIX_SQL} FROM cohort),
sc AS (SELECT id, label, {LOGIT_SQL} AS log_odds FROM mx)
"""


def matrix(spark, sf):
    return MODEL.matrix(cohort(spark, sf), ["id", "label"])


@register("batch_score", C + """
SELECT id, log_odds, round(1 / (1 + exp(-log_odds)), 4) AS probability, CAST(log_odds > 0 AS INT) AS pred,
       'given-1' AS model_version FROM sc
""")
def q_batch_score(spark, sf):
    return X.batch_score(matrix(spark, sf), MODEL, "id", digits=4, version="given-1")


LONG_SQL = ",\nlong AS (" + "\nUNION ALL\n".join(
    f"SELECT id, '{f}' AS feature, {f} AS value, {_lit(c)} AS coef FROM mx" for f, c in COEFS) + ")\n"


@register("row_contributions", C + LONG_SQL + f"""
SELECT id, feature, value, value * coef AS contribution,
       {_lit(INTERCEPT)} + sum(value * coef) OVER (PARTITION BY id) AS log_odds,
       1 / (1 + exp(-({_lit(INTERCEPT)} + sum(value * coef) OVER (PARTITION BY id)))) AS probability,
       CAST(row_number() OVER (PARTITION BY id ORDER BY abs(value * coef) DESC, feature) AS INTEGER) AS rank
FROM long
""")
def q_row_contributions(spark, sf):
    return X.row_contributions(matrix(spark, sf), MODEL, "id")


@register("contribution_strength", C + LONG_SQL + """,
a AS (SELECT id, feature, value * coef AS contribution,
             row_number() OVER (PARTITION BY id ORDER BY abs(value * coef) DESC, feature) - 1 AS r,
             count(*) OVER (PARTITION BY id) AS n, sum(abs(value * coef)) OVER (PARTITION BY id) AS tot
      FROM long WHERE abs(value) > 1e-9)
SELECT id, feature, contribution, CASE WHEN tot > 0 THEN abs(contribution) / tot * 100 ELSE 0.0 END AS relative_pct,
       CASE WHEN r < n / 3.0 THEN 'Strong' WHEN r < 2 * n / 3.0 THEN 'Moderate' ELSE 'Weak' END AS strength,
       CASE WHEN contribution > 0 THEN 'positive' WHEN contribution < 0 THEN 'negative' ELSE 'zero' END AS direction
FROM a
""")
def q_contribution_strength(spark, sf):
    return X.contribution_strength(matrix(spark, sf), MODEL, "id")


@register("linear_shap", C + split_cte() + LONG_SQL + f""",
means AS (SELECT feature, CAST(sum(CAST(value AS DECIMAL(28, 9))) AS DOUBLE) / count(value) AS mean FROM long WHERE id IN (SELECT _key FROM split WHERE split = 'train')
          GROUP BY feature),
base AS (SELECT {_lit(INTERCEPT)} + sum(coef * mean) AS base FROM (SELECT DISTINCT feature, coef FROM long) c
         JOIN means USING (feature)),
s AS (SELECT l.id, l.feature, l.value, l.coef * (l.value - m.mean) AS shap FROM long l JOIN means m USING (feature))
SELECT id, feature, value, shap, base,
       base + sum(shap) OVER (PARTITION BY id ORDER BY abs(shap) DESC, feature
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total,
       abs(value) > 1e-9 AS active
FROM s, base
""")
def q_linear_shap(spark, sf):
    """Against the mean of the training split."""
    df, m = cohort(spark, sf), matrix(spark, sf)
    train = S.stratified_split(df, "id", "label").where(F.col("split") == "train").select("id")
    return X.linear_shap(m, m.join(train, "id", "left_semi"), MODEL, "id")


TEST_IDS = "id IN (SELECT _key FROM split WHERE split = 'test')"


@register("confidence_bands", C + split_cte() + f""",
cuts AS (SELECT quantile_cont(abs(log_odds), 0.3333) AS weak_cut, quantile_cont(abs(log_odds), 0.6667) AS strong_cut
         FROM sc WHERE {TEST_IDS}),
p AS (SELECT id, 1 / (1 + exp(-log_odds)) AS probability, log_odds FROM sc)
SELECT id, probability, log_odds,
       CASE WHEN abs(probability - 0.5) >= 0.35 THEN 'High' WHEN abs(probability - 0.5) >= 0.15 THEN 'Moderate'
            ELSE 'Low' END AS confidence,
       CASE WHEN abs(log_odds) >= strong_cut THEN 'Strong' WHEN abs(log_odds) >= weak_cut THEN 'Moderate'
            ELSE 'Weak' END AS strength
FROM p, cuts
""")
def q_confidence_bands(spark, sf):
    df = cohort(spark, sf)
    test_ids = S.stratified_split(df, "id", "label").where(F.col("split") == "test").select("id")
    scores = X.batch_score(MODEL.matrix(df, ["id", "label"]), MODEL, "id")
    return X.confidence_bands(scores, scores.join(test_ids, "id", "left_semi"), "id")


# X7 / X8 ----------------------------------------------------------------------------------
def _half_up(x: float, digits: int = 0) -> float:
    k = 10 ** digits
    return math.floor(x * k + 0.5) / k


def candidate_values(spark, sf):
    """Realistic replacement values from the population reference."""
    ref = P.population_reference(cohort(spark, sf), "age", "fare", "sibsp", "parch").first()
    ages = sorted({_half_up(ref[f"age_{k}"]) for k in ("q25", "median", "q75")})
    fares = sorted({_half_up(ref[f"fare_{k}"], 2) for k in ("q25", "median", "q75")})
    return ages, fares, ref["family_max"]


def candidates(ages, fares, family_max):
    col = F.col
    fam = col("sibsp") + col("parch") + 1
    out = []
    for pc in (1, 2, 3):
        out.append((f"pclass:{pc}", "pclass", F.lit(pc), col("pclass") != pc))
    out.append(("sex:flip", "sex", F.when(col("sex") == "female", "male").otherwise("female"), F.lit(True)))
    for e in ("S", "C", "Q"):
        out.append((f"embarked:{e}", "embarked", F.lit(e), col("embarked") != e))
    for a in ages:
        out.append((f"age:{a}", "age", F.lit(float(a)), F.abs(F.lit(float(a)) - col("age")) >= 2))
    for v in fares:
        out.append((f"fare:{v}", "fare", F.lit(float(v)), F.abs(F.lit(float(v)) - col("fare")) >= 1))
    for d in (-1, 1):
        out.append((f"family:{d:+d}", "sibsp", col("sibsp") + d,
                    (fam + d >= 1) & (fam + d <= family_max)))
    return out


def counterfactual_frame(spark, sf):
    ages, fares, fmax = candidate_values(spark, sf)
    raw = cohort(spark, sf).select(*RAW).drop("label")
    return X.counterfactuals(raw, MODEL, "id", candidates(ages, fares, fmax)), (ages, fares, fmax)


CF_COLS = ["pclass", "sex", "age", "sibsp", "parch", "fare", "cabin", "embarked"]


def _variant(label: str, column: str, value: str, guard: str, value_text: str, source: str = "cohort") -> str:
    sel = ", ".join(f"{value} AS {c}" if c == column else c for c in CF_COLS)
    return (f"SELECT id, {label} AS change, {value_text} AS new_value, {sel} FROM {source} "
            f"WHERE COALESCE({guard}, FALSE)")


_FLIP = "CASE WHEN sex = 'female' THEN 'male' ELSE 'female' END"
_CF_PARTS = (
    [_variant(f"'pclass:{pc}'", "pclass", str(pc), f"pclass <> {pc}", f"'{pc}'") for pc in (1, 2, 3)]
    + [_variant("'sex:flip'", "sex", _FLIP, "TRUE", _FLIP)]
    + [_variant(f"'embarked:{e}'", "embarked", f"'{e}'", f"embarked <> '{e}'", f"'{e}'") for e in ("S", "C", "Q")]
    + [_variant("'age:' || CAST(ages.v AS VARCHAR)", "age", "ages.v", "abs(ages.v - age) >= 2",
                "CAST(ages.v AS VARCHAR)", "cohort, ages")]
    + [_variant("'fare:' || CAST(fares.v AS VARCHAR)", "fare", "fares.v", "abs(fares.v - fare) >= 1",
                "CAST(fares.v AS VARCHAR)", "cohort, fares")]
    + [_variant(f"'family:{d:+d}'", "sibsp", f"sibsp + ({d})",
                f"sibsp + parch + 1 + ({d}) >= 1 AND sibsp + parch + 1 + ({d}) <= (SELECT fmax FROM pop)",
                f"CAST(sibsp + ({d}) AS VARCHAR)") for d in (-1, 1)]
)

CF_SQL = C + f""",
pop AS (SELECT quantile_cont(age, 0.25) AS a1, quantile_cont(age, 0.5) AS a2, quantile_cont(age, 0.75) AS a3,
               quantile_cont(fare, 0.25) AS f1, quantile_cont(fare, 0.5) AS f2, quantile_cont(fare, 0.75) AS f3,
               max(sibsp + parch + 1) AS fmax FROM cohort),
ages AS (SELECT DISTINCT floor(x + 0.5) AS v FROM (SELECT unnest([a1, a2, a3]) AS x FROM pop)),
fares AS (SELECT DISTINCT floor(x * 100 + 0.5) / 100 AS v FROM (SELECT unnest([f1, f2, f3]) AS x FROM pop)),
v AS ({chr(10).join(p if i == 0 else 'UNION ALL ' + p for i, p in enumerate(_CF_PARTS))}),
vm AS (SELECT id, change, new_value, {LOGIT_SQL} AS lo2 FROM (SELECT id, change, new_value, {MATRIX_SQL} FROM v)),
cf AS (SELECT vm.id, change, new_value, 1 / (1 + exp(-sc.log_odds)) AS probability,
              1 / (1 + exp(-lo2)) AS new_probability,
              1 / (1 + exp(-lo2)) - 1 / (1 + exp(-sc.log_odds)) AS difference,
              (lo2 > 0) <> (sc.log_odds > 0) AS flips
       FROM vm JOIN sc ON vm.id = sc.id)
"""


@register("counterfactuals", CF_SQL + "SELECT * FROM cf")
def q_counterfactuals(spark, sf):
    """Every realistic one-column change of every row."""
    return counterfactual_frame(spark, sf)[0]


@register("prediction_stability", CF_SQL + """
SELECT id, max(abs(difference)) AS max_swing, bool_or(flips) AS any_flip,
       arg_min(change, struct_pack(a := abs(difference), b := change)) FILTER (WHERE flips) AS smallest_flip,
       CASE WHEN bool_or(flips) THEN 'Unstable' WHEN max(abs(difference)) >= 0.15 THEN 'Moderately Stable'
            WHEN max(abs(difference)) >= 0.05 THEN 'Stable' ELSE 'Very Stable' END AS stability
FROM cf GROUP BY id
""")
def q_prediction_stability(spark, sf):
    """Smallest flipping change and stability label per row."""
    return X.prediction_stability(counterfactual_frame(spark, sf)[0], "id")


@register("feature_sensitivity", CF_SQL + """
SELECT id, split_part(change, ':', 1) AS "column", max(abs(difference)) AS max_abs_difference FROM cf GROUP BY ALL
""")
def q_feature_sensitivity(spark, sf):
    """Per row and changed column, the largest absolute change."""
    return X.feature_sensitivity(counterfactual_frame(spark, sf)[0], "id")


# X9 ---------------------------------------------------------------------------------------
WRONG_SQL = """,
wrong AS (SELECT id FROM sc WHERE label <> CAST(log_odds > 0 AS INT) ORDER BY abs(log_odds) DESC, id LIMIT 8)
"""
DIST_SQL = " + ".join(f"(h.{f} - q.{f}) * (h.{f} - q.{f})" for f, _ in COEFS)


@register("nearest_rows", C + WRONG_SQL + f""",
q AS (SELECT mx.* FROM mx JOIN wrong USING (id)),
d AS (SELECT q.id AS query_id, h.id AS neighbor_id, sqrt({DIST_SQL}) AS distance FROM q, mx h WHERE h.id <> q.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM d)
SELECT query_id, neighbor_id, distance, CAST(rank AS INT) AS rank, 100 / (1 + distance) AS similarity
FROM r WHERE rank <= 3
""")
def q_nearest_rows(spark, sf):
    """The nearest history rows of the model's 8 most confidently wrong rows."""
    m = matrix(spark, sf)
    lo = MODEL.logit()
    wrong = (m.where(F.col("label") != (lo > 0).cast("int")).withColumn("_a", F.abs(lo))
             .orderBy(F.col("_a").desc(), F.col("id")).limit(8).select("id"))
    queries = m.join(wrong, "id", "left_semi")
    out = X.nearest_rows(queries, m, "id", [f for f, _ in COEFS], k=3)
    return out.select("query_id", "neighbor_id", "distance", F.col("rank").cast("int").alias("rank"), "similarity")


_TRAIN_STATS = ", ".join(f"round(avg({f}), 6) AS {f}_mu, COALESCE(NULLIF(round(stddev_pop({f}), 6), 0), 1) AS {f}_sd"
                         for f, _ in COEFS)
_SCALED = ", ".join(f"({f} - {f}_mu) / {f}_sd AS {f}" for f, _ in COEFS)


@register("similar_history", C + split_cte() + f""",
ms AS (SELECT mx.*, split FROM mx JOIN split ON id = _key),
st AS (SELECT {_TRAIN_STATS} FROM ms WHERE split = 'train'),
z AS (SELECT id, split, {_SCALED} FROM ms, st),
d AS (SELECT q.id AS query_id, min({{'distance': sqrt({DIST_SQL}), 'neighbor_id': h.id}}, 3) AS near
      FROM z q, z h WHERE q.split = 'test' AND h.split = 'train' GROUP BY q.id),
r AS (SELECT query_id, unnest(near) AS n, unnest(range(1, len(near) + 1)) AS rank FROM d)
SELECT query_id, n.neighbor_id AS neighbor_id, n.distance AS distance, CAST(rank AS INT) AS rank,
       100 / (1 + n.distance) AS similarity FROM r
""")
def q_similar_history(spark, sf):
    """Every row of the test split against the training split, in the space scaled on the latter."""
    m = matrix(spark, sf).join(S.stratified_split(cohort(spark, sf), "id", "label").select("id", "split"), "id")
    own = [f for f, _ in COEFS]
    stats = m.where(F.col("split") == "train").agg(
        *[F.round(F.avg(f), 6).alias(f"{f}_mu") for f in own],
        *[F.coalesce(F.nullif(F.round(F.stddev_pop(f), 6), F.lit(0.0)), F.lit(1.0)).alias(f"{f}_sd") for f in own])
    z = m.crossJoin(F.broadcast(stats)).select(  # one row
        "id", "split", *[((F.col(f) - F.col(f"{f}_mu")) / F.col(f"{f}_sd")).alias(f) for f in own])
    out = X.nearest_rows(z.where(F.col("split") == "test"), z.where(F.col("split") == "train"), "id", own, k=3)
    return out.select("query_id", "neighbor_id", "distance", F.col("rank").cast("int").alias("rank"), "similarity")


@register("nearest_embeddings", """
WITH d AS (SELECT q.vec_id AS query_id, h.vec_id AS neighbor_id, round(sqrt(list_sum(list_transform(range(1, len(q.embedding) + 1),
             lambda i: (CAST(h.embedding[i] AS DOUBLE) - q.embedding[i]) * (CAST(h.embedding[i] AS DOUBLE) - q.embedding[i])))), 6) AS distance
           FROM embeddings q, embeddings h WHERE q.vec_id % 50 = 0 AND h.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM d)
SELECT query_id, neighbor_id, distance, CAST(rank AS INT) AS rank FROM r WHERE rank <= 5
""")
def q_nearest_embeddings(spark, sf):
    """X9 over `embeddings`: the five nearest rows of every fiftieth one, among all."""
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    out = nearest(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding", k=5)
    return out.select("query_id", "neighbor_id", F.round("distance", 6).alias("distance"),
                      F.col("rank").cast("int").alias("rank"))


# X2 ---------------------------------------------------------------------------------------
PERM_COLS = ["sex", "pclass", "age", "fare", "embarked"]


PERM_SQL = C + split_cte() + f""",
ranked AS (SELECT {", ".join("c." + c for c in RAW)}, count(*) OVER () AS n,
                  row_number() OVER (ORDER BY CAST('0x' || substr(md5(CAST(c.id AS VARCHAR) || '|42'), 1, 8) AS BIGINT),
                                     c.id) - 1 AS i
           FROM cohort c JOIN split s ON c.id = s._key WHERE s.split = 'test'),
reps AS (SELECT unnest(range(0, 30)) AS rep),
cols AS (SELECT unnest({PERM_COLS}) AS col),
given AS (SELECT a.id, a.label, a.sibsp, a.parch, a.cabin, rep, col,
                 {", ".join(f"CASE WHEN col = '{c}' THEN d.{c} ELSE a.{c} END AS {c}" for c in PERM_COLS)}
          FROM ranked a CROSS JOIN reps CROSS JOIN cols JOIN ranked d ON d.i = (a.i + 1 + (rep * (a.n - 1)) // 30) % a.n),
m AS (SELECT label, rep, col, {MATRIX_SQL} FROM given),
pr AS (SELECT label, rep, col, {LOGIT_SQL} > 0 AS p FROM m),
f AS (SELECT rep, col, 2.0 * count(*) FILTER (WHERE p AND label = 1) AS tp2,
             count(*) FILTER (WHERE p <> (label = 1)) AS wrong FROM pr GROUP BY rep, col),
b AS (SELECT 2.0 * count(*) FILTER (WHERE p AND label = 1) AS tp2, count(*) FILTER (WHERE p <> (label = 1)) AS wrong
      FROM (SELECT sc.label, log_odds > 0 AS p FROM sc JOIN ranked USING (id))),
d AS (SELECT col, COALESCE(b.tp2 / NULLIF(b.tp2 + b.wrong, 0), 0) - COALESCE(f.tp2 / NULLIF(f.tp2 + f.wrong, 0), 0) AS drop_
      FROM f, b)
SELECT col AS "column", avg(drop_) AS importance, stddev_pop(drop_) AS importance_std FROM d GROUP BY col
"""


@register("permutation_importance", PERM_SQL)
def q_permutation_importance(spark, sf):
    """Mean F1 drop over 30 permutations per raw column, on the test split."""
    df = cohort(spark, sf)
    test = S.stratified_split(df, "id", "label").where(F.col("split") == "test").select(*RAW)
    return X.permutation_importance(test, MODEL, "id", "label", PERM_COLS, repeats=30)
