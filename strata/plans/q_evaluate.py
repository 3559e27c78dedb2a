"""Evaluation queries (E1-E15, R4, P3) over the ``scored`` fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import bootstrap as B
from strata.operators import evaluate as E
from strata.plans.catalog import register
from strata.plans.fixtures import oracle_with, scored

S = oracle_with("scored") + """,
p AS (SELECT *, CAST(score >= 0.5 AS INT) AS pred FROM scored)
"""


def sp(spark, sf):
    return scored(spark, sf).withColumn("pred", (F.col("score") >= 0.5).cast("int"))


def _metrics_sql(group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {g}n, tp, fp, fn, tn,
  CAST(tp + tn AS DOUBLE) / n AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1
FROM (SELECT {g}count(*) AS n, count(*) FILTER (WHERE pred = 1 AND label = 1) AS tp,
             count(*) FILTER (WHERE pred = 1 AND label <> 1) AS fp,
             count(*) FILTER (WHERE pred <> 1 AND label = 1) AS fn,
             count(*) FILTER (WHERE pred <> 1 AND label <> 1) AS tn FROM p {gb})
"""


@register("classification_metrics", S + _metrics_sql())
def q_classification_metrics(spark, sf):
    return E.classification_metrics(sp(spark, sf), "label", "pred")


@register("roc_auc", S + """,
vc AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
       FROM scored WHERE score IS NOT NULL GROUP BY score),
c AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM vc)
SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
       CAST(sum(pos * (below + 0.5 * neg)) AS DOUBLE) AS u,
       sum(pos * (below + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc FROM c
""")
def q_roc_auc(spark, sf):
    return E.roc_auc(scored(spark, sf), "label", "score")


DESC = """,
vc AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
       FROM scored WHERE score IS NOT NULL GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cum_pos, sum(neg) OVER (ORDER BY score DESC) AS cum_neg,
             sum(pos) OVER () AS tot_pos, sum(neg) OVER () AS tot_neg FROM vc)
"""


@register("average_precision", S + DESC + """
SELECT sum(CAST(pos AS DOUBLE) / tot_pos * cum_pos / (cum_pos + cum_neg)) AS average_precision FROM c
""")
def q_average_precision(spark, sf):
    return E.average_precision(scored(spark, sf), "label", "score")


@register("roc_curve", S + DESC + """
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL SELECT score, CAST(cum_neg AS DOUBLE) / tot_neg, CAST(cum_pos AS DOUBLE) / tot_pos FROM c
""")
def q_roc_curve(spark, sf):
    return E.roc_curve(scored(spark, sf), "label", "score")


@register("pr_curve", S + DESC + """
SELECT score AS threshold, CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg) AS precision,
       CAST(cum_pos AS DOUBLE) / tot_pos AS recall, CAST(tot_pos AS DOUBLE) / (tot_pos + tot_neg) AS base_rate FROM c
UNION ALL SELECT NULL, 1.0, 0.0, (SELECT avg(CAST(label AS DOUBLE)) FROM scored WHERE score IS NOT NULL)
""")
def q_pr_curve(spark, sf):
    return E.pr_curve(scored(spark, sf), "label", "score")


@register("brier", S + """
SELECT avg(power(score - label, 2)) AS brier, avg(CAST(label AS DOUBLE)) AS base_rate,
       avg(CAST(label AS DOUBLE)) * (1 - avg(CAST(label AS DOUBLE))) AS brier_base FROM scored
""")
def q_brier(spark, sf):
    return E.brier(scored(spark, sf), "label", "score")


@register("confusion_matrix", S + """
SELECT g.label, g.pred, COALESCE(c.n, 0) AS n
FROM (SELECT a AS label, b AS pred FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b)) g
LEFT JOIN (SELECT label, pred, count(*) AS n FROM p GROUP BY ALL) c ON g.label = c.label AND g.pred = c.pred
""")
def q_confusion_matrix(spark, sf):
    return E.confusion_matrix(sp(spark, sf), "label", "pred")


@register("class_report", S + """,
c AS (SELECT count(*) FILTER (WHERE label = 0 AND pred = 0) AS n00, count(*) FILTER (WHERE label = 0 AND pred = 1) AS n01,
             count(*) FILTER (WHERE label = 1 AND pred = 0) AS n10, count(*) FILTER (WHERE label = 1 AND pred = 1) AS n11 FROM p),
per AS (
  SELECT '0' AS class, CASE WHEN n00 + n10 = 0 THEN 0.0 ELSE n00 / (n00 + n10) END AS precision,
         CASE WHEN n00 + n01 = 0 THEN 0.0 ELSE n00 / (n00 + n01) END AS recall,
         CASE WHEN 2 * n00 + n10 + n01 = 0 THEN 0.0 ELSE 2 * n00 / (2 * n00 + n10 + n01) END AS f1,
         n00 + n01 AS support FROM c
  UNION ALL
  SELECT '1', CASE WHEN n11 + n01 = 0 THEN 0.0 ELSE n11 / (n11 + n01) END,
         CASE WHEN n11 + n10 = 0 THEN 0.0 ELSE n11 / (n11 + n10) END,
         CASE WHEN 2 * n11 + n01 + n10 = 0 THEN 0.0 ELSE 2 * n11 / (2 * n11 + n01 + n10) END, n11 + n10 FROM c)
SELECT * FROM per
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per
""")
def q_class_report(spark, sf):
    return E.class_report(sp(spark, sf), "label", "pred")


@register("calibration", S + """,
e AS (SELECT quantile_cont(score, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) AS edges FROM scored)
SELECT CAST(len(list_filter(edges, lambda x: x < score)) AS INT) AS bin, count(*) AS n, avg(score) AS mean_score,
       avg(CAST(label AS DOUBLE)) AS observed_rate
FROM scored, e GROUP BY 1
""")
def q_calibration(spark, sf):
    return E.calibration(scored(spark, sf), "label", "score", 8)


SWEEP = S + """,
t AS (SELECT range AS k, range / 100 AS threshold FROM range(5, 96)),
sw AS (SELECT t.threshold, count(*) FILTER (WHERE s.score >= t.threshold AND s.label = 1) AS tp,
              count(*) FILTER (WHERE s.score >= t.threshold AND s.label <> 1) AS fp,
              count(*) FILTER (WHERE s.label = 1) AS pp
       FROM t, scored s GROUP BY t.threshold),
m AS (SELECT threshold, tp, fp, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
             CASE WHEN pp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pp END AS recall,
             CASE WHEN tp + fp + pp = 0 THEN 0.0 ELSE 2.0 * tp / (tp + fp + pp) END AS f1 FROM sw)
"""


@register("threshold_sweep", SWEEP + "SELECT * FROM m")
def q_threshold_sweep(spark, sf):
    return E.threshold_sweep(scored(spark, sf), "label", "score")


@register("best_threshold", SWEEP + """
SELECT arg_min(threshold, struct_pack(a := -f1, b := threshold)) AS best_threshold, max(f1) AS best_f1,
       max(CASE WHEN abs(threshold - 0.5) < 1e-12 THEN f1 END) AS f1_at_default FROM m
""")
def q_best_threshold(spark, sf):
    return E.best_threshold(E.threshold_sweep(scored(spark, sf), "label", "score"))


@register("subgroup_metrics", S + """,
long AS (SELECT 'sex' AS grouping, sex AS value, label, pred FROM p
         UNION ALL SELECT 'pclass', CAST(pclass AS VARCHAR), label, pred FROM p),
m AS (""" + _metrics_sql("grouping, value").replace("FROM p", "FROM long") + """)
SELECT grouping, value, n, accuracy, precision, recall, f1,
       recall = min(recall) OVER (PARTITION BY grouping) AS lowest_recall FROM m
""")
def q_subgroup_metrics(spark, sf):
    return E.subgroup_metrics(sp(spark, sf), "label", "pred", ["sex", "pclass"])


@register("error_composition", S + """,
long AS (SELECT 'sex' AS grouping, sex AS value, label, pred FROM p
         UNION ALL SELECT 'pclass', CAST(pclass AS VARCHAR), label, pred FROM p),
e AS (SELECT grouping, value, count(*) AS n_all, count(*) FILTER (WHERE label = 0 AND pred = 1) AS n_fp,
             count(*) FILTER (WHERE label = 1 AND pred = 0) AS n_fn FROM long GROUP BY ALL)
SELECT grouping, value, n_all, n_fp, n_fn,
       n_all / sum(n_all) OVER (PARTITION BY grouping) AS share_all,
       CASE WHEN sum(n_fp) OVER (PARTITION BY grouping) = 0 THEN 0.0
            ELSE n_fp / sum(n_fp) OVER (PARTITION BY grouping) END AS share_fp,
       CASE WHEN sum(n_fn) OVER (PARTITION BY grouping) = 0 THEN 0.0
            ELSE n_fn / sum(n_fn) OVER (PARTITION BY grouping) END AS share_fn
FROM e
""")
def q_error_composition(spark, sf):
    return E.error_composition(sp(spark, sf), "label", "pred", ["sex", "pclass"])


@register("error_rows", S + """
SELECT id, label, pred, score, CASE WHEN pred = 1 THEN 'FP' ELSE 'FN' END AS error FROM p WHERE label <> pred
""")
def q_error_rows(spark, sf):
    return E.error_rows(sp(spark, sf), "label", "pred").select("id", "label", "pred", "score", "error")


@register("worst_errors", S + """
SELECT id, label, score, CASE WHEN label = 1 THEN 1 - score ELSE score END AS miss_margin
FROM p WHERE label <> pred ORDER BY miss_margin DESC, id LIMIT 8
""")
def q_worst_errors(spark, sf):
    return E.worst_errors(sp(spark, sf), "label", "pred", "score", "id", 8).select(
        "id", "label", "score", "miss_margin")


@register("extreme_cases", S + """,
t AS (SELECT CASE WHEN label = 1 AND pred = 1 THEN 'best_true_positive'
                  WHEN label = 0 AND pred = 0 THEN 'surest_true_negative'
                  WHEN label = 0 AND pred = 1 THEN 'top_false_positive' ELSE 'top_false_negative' END AS "case",
             id, score FROM p)
SELECT "case", arg_min(id, struct_pack(a := CASE WHEN "case" IN ('best_true_positive', 'top_false_positive')
                                            THEN -score ELSE score END, b := id)) AS id,
       arg_min(score, struct_pack(a := CASE WHEN "case" IN ('best_true_positive', 'top_false_positive')
                                       THEN -score ELSE score END, b := id)) AS score
FROM t GROUP BY "case"
""")
def q_extreme_cases(spark, sf):
    return E.extreme_cases(sp(spark, sf), "label", "pred", "score", "id")


def four_models(spark, sf):
    """The two fixture scores and two blends of them."""
    a, b = F.col("score"), F.col("score_b")
    return scored(spark, sf).withColumns({"score_c": (a + b) / 2, "score_d": F.greatest(a, b)}), {
        "model_a": "score", "model_b": "score_b", "model_c": "score_c", "model_d": "score_d"}


@register("bootstrap_ci")
def q_bootstrap_ci(spark, sf):
    """Paired bootstrap intervals of four models on the same rows, AUC on the scores (rows-only)."""
    df, models = four_models(spark, sf)
    return B.bootstrap_ci(df, "label", models)


@register("metric_intervals")
def q_metric_intervals(spark, sf):
    """Point metrics with clipped bootstrap error bars (rows-only)."""
    df, models = four_models(spark, sf)
    return E.metric_intervals(E.long_metrics(df, "label", models), B.bootstrap_ci(df, "label", models))


@register("paired_difference")
def q_paired_difference(spark, sf):
    """Intervals of each model's advantage over the first one in the same replicates (rows-only)."""
    df, models = four_models(spark, sf)
    return B.paired_difference(B.bootstrap_values(df, "label", models), "model_a")


@register("paired_predictions", S + """
SELECT id, label, score AS model_a, score_b AS model_b,
       CASE WHEN CAST(score >= 0.5 AS INT) = label THEN 'correct' ELSE 'wrong' END AS outcome_a,
       CASE WHEN CAST(score_b >= 0.5 AS INT) = label THEN 'correct' ELSE 'wrong' END AS outcome_b
FROM scored
""")
def q_paired_predictions(spark, sf):
    """J6 + P10: predictions of two models stored long, paired by id (pivot),
    with the 0/1 outcome mapped to words."""
    from strata.operators.profile import map_codes, pair_by_key

    df = scored(spark, sf)
    long = (df.select("id", "label", F.lit("model_a").alias("model"), F.col("score").alias("p"))
            .unionByName(df.select("id", "label", F.lit("model_b").alias("model"), F.col("score_b").alias("p"))))
    wide = pair_by_key(long.drop("label"), "id", "model", "p", ["model_a", "model_b"])
    out = wide.join(df.select("id", "label"), "id")
    words = {1: "correct", 0: "wrong"}
    hits = out.withColumns({f"_ok_{m}": ((F.col(m) >= 0.5).cast("int") == F.col("label")).cast("int")
                            for m in ("model_a", "model_b")})
    return hits.select("id", "label", "model_a", "model_b", map_codes("_ok_model_a", words).alias("outcome_a"),
                       map_codes("_ok_model_b", words).alias("outcome_b"))
