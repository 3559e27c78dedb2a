"""Evaluation of a scored table ``(id, label, score, pred, group...)``.

Curves and rank metrics go through per-distinct-score counts and the
bucketed prefix sums of ``functions.ranks`` (never a window over all rows);
the threshold sweep is a histogram of rows by the highest threshold they
pass plus a reverse running sum over the 91 thresholds (not rows x 91).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.ranks import bucket_expr, cumulative, exact_quantiles, label_counts, rank_sum_auc, with_totals


def _div0(a: Column, b: Column) -> Column:
    """a / b with 0 / 0 (or x / 0) giving 0 (sklearn ``zero_division=0``)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _metric_cols(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    prec = _div0(tp, tp + fp)
    rec = _div0(tp, tp + fn)
    return [
        _div0(tp + tn, tp + fp + fn + tn).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
        _div0(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def confusion_counts(label: str, pred: str) -> list[Column]:
    y, p = F.col(label), F.col(pred)
    return [F.count_if((p == 1) & (y == 1)).alias("tp"), F.count_if((p == 1) & (y != 1)).alias("fp"),
            F.count_if((p != 1) & (y == 1)).alias("fn"), F.count_if((p != 1) & (y != 1)).alias("tn")]


# E1 ---------------------------------------------------------------------------------------
def classification_metrics(df: DataFrame, label: str, pred: str, group_cols: list[str] | None = None) -> DataFrame:
    g = list(group_cols or [])
    agg = df.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), *confusion_counts(label, pred))
    return agg.select(*g, "n", "tp", "fp", "fn", "tn",
                      *_metric_cols(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


# E2 ---------------------------------------------------------------------------------------
def roc_auc(df: DataFrame, label: str, score: str, group_cols: list[str] | None = None) -> DataFrame:
    return rank_sum_auc(df, label, score, group_cols)


# E3 / E7 / E8 -----------------------------------------------------------------------------
def _desc_cum(df: DataFrame, label: str, score: str, group_cols: list[str] | None = None) -> DataFrame:
    """Per distinct score, running pos / neg counts from the top score down."""
    counts = label_counts(df, score, label, group_cols)
    return cumulative(counts, score, ["pos", "neg"], group_cols, descending=True)


def average_precision(df: DataFrame, label: str, score: str, group_cols: list[str] | None = None) -> DataFrame:
    """Step-sum AP: sum over distinct scores (descending) of
    (recall gain) x (precision at that score)."""
    g = list(group_cols or [])
    cum = _desc_cum(df, label, score, g)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))  # >= 1 row at every score
    return cum.groupBy(*g).agg(F.sum(F.try_divide(F.col("pos"), F.col("tot_pos")) * prec).alias("average_precision"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """All ROC points (threshold, fpr, tpr) by distinct score descending,
    plus the start point (inf, 0, 0)."""
    cum = _desc_cum(df, label, score)
    pts = cum.select(F.col(score).cast("double").alias("threshold"),
                     F.try_divide(F.col("cum_neg"), F.col("tot_neg")).alias("fpr"),
                     F.try_divide(F.col("cum_pos"), F.col("tot_pos")).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(pts)


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision-recall points by distinct score, plus the end point
    (recall 0, precision 1, no threshold); base rate as a column."""
    cum = _desc_cum(df, label, score)
    pts = cum.select(F.col(score).cast("double").alias("threshold"),
                     (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                     F.try_divide(F.col("cum_pos"), F.col("tot_pos")).alias("recall"),
                     (F.col("tot_pos") / (F.col("tot_pos") + F.col("tot_neg"))).alias("base_rate"))
    end = pts.groupBy().agg(F.first("base_rate").alias("base_rate")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"), "base_rate")
    return pts.unionByName(end)


# E4 ---------------------------------------------------------------------------------------
def brier(df: DataFrame, label: str, score: str) -> DataFrame:
    y = F.col(label).cast("double")
    return df.agg(F.avg((F.col(score) - y) ** 2).alias("brier"), F.avg(y).alias("base_rate")).withColumn(
        "brier_base", F.col("base_rate") * (1 - F.col("base_rate")))


# E5 / E6 ----------------------------------------------------------------------------------
def confusion_matrix(df: DataFrame, label: str, pred: str, levels: list = (0, 1)) -> DataFrame:
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in levels for b in levels], f"{label} int, {pred} int")
    counts = df.groupBy(F.col(label).cast("int").alias(label), F.col(pred).cast("int").alias(pred)).agg(
        F.count(F.lit(1)).alias("n"))
    return grid.join(counts, [label, pred], "left").select(label, pred, F.coalesce("n", F.lit(0)).alias("n"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision / recall / F1 / support, then macro and weighted means."""
    c = confusion_matrix(df, label, pred).agg(
        *[F.sum(F.when((F.col(label) == a) & (F.col(pred) == b), F.col("n"))).alias(f"n{a}{b}")
          for a in (0, 1) for b in (0, 1)])
    rows = []
    for k in (0, 1):
        tp = F.col(f"n{k}{k}")
        fp = F.col(f"n{1 - k}{k}")
        fn = F.col(f"n{k}{1 - k}")
        rows.append(F.struct(F.lit(str(k)).alias("class"), _div0(tp, tp + fp).alias("precision"),
                             _div0(tp, tp + fn).alias("recall"), _div0(2 * tp, 2 * tp + fp + fn).alias("f1"),
                             (tp + fn).alias("support")))
    per = c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    tot = F.sum("support")
    avg = per.agg(
        F.struct(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.alias("support")).alias("m"),
        F.struct(F.lit("weighted avg").alias("class"),
                 (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                 (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                 (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"), tot.alias("support")).alias("w"))
    return per.unionByName(avg.select("m.*")).unionByName(avg.select("w.*"))


def _with_score(df: DataFrame, score: str) -> DataFrame:
    """Rows that were scored: a NULL or NaN score is neither above nor below any threshold."""
    s = F.col(score).cast("double")
    return df.where(s.isNotNull() & ~F.isnan(s))


# E9 ---------------------------------------------------------------------------------------
def calibration(df: DataFrame, label: str, score: str, n_bins: int = 8) -> DataFrame:
    """Quantile bins; a score equal to an inner edge goes to the lower bin;
    empty bins are absent. Returns bin, n, mean_score, observed_rate."""
    probs = [i / n_bins for i in range(1, n_bins)]
    df = _with_score(df, score)
    edges = exact_quantiles(df.select(score), score, probs).agg(
        F.array_sort(F.collect_list("value")).alias("_edges"))  # n_bins - 1 values
    b = F.size(F.filter("_edges", lambda e: e < F.col(score)))
    return (df.crossJoin(F.broadcast(edges)).withColumn("bin", b.cast("int"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"),
                                F.avg(F.col(label).cast("double")).alias("observed_rate")))


# E10 --------------------------------------------------------------------------------------
def threshold_sweep(df: DataFrame, label: str, score: str, lo: int = 5, hi: int = 95,
                    per: int = 100) -> DataFrame:
    """Precision / recall / F1 at thresholds k / per for k in [lo, hi]
    (prediction = score >= threshold)."""
    spark = df.sparkSession
    df = _with_score(df, score)
    ks = list(range(lo, hi + 1))
    cuts = [k / per for k in ks]
    # bucket = number of thresholds <= score: the row is positive at
    # threshold index j exactly when j < bucket
    hist = (df.groupBy(bucket_expr(F.col(score), cuts).alias("b"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))
    th = spark.createDataFrame([(j, k / per) for j, k in enumerate(ks)], "j int, threshold double")
    # 92 x 91 rows at most: both sides are small
    joined = th.crossJoin(F.broadcast(hist)).where(F.col("b") > F.col("j"))
    tot = hist.agg(F.sum("pos").alias("P"))
    agg = (th.join(joined.groupBy("j").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp")), "j", "left")
           .crossJoin(F.broadcast(tot))
           .select("j", "threshold", F.coalesce("tp", F.lit(0)).alias("tp"),
                   F.coalesce("fp", F.lit(0)).alias("fp"), "P"))
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("P") - tp
    return agg.select("threshold", "tp", "fp", _div0(tp, tp + fp).alias("precision"),
                      _div0(tp, tp + fn).alias("recall"), _div0(2 * tp, 2 * tp + fp + fn).alias("f1"))


def best_threshold(sweep: DataFrame, at: float = 0.5) -> DataFrame:
    """First threshold with the highest F1, and F1 at ``at``."""
    return sweep.agg(
        F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("best_threshold"),
        F.max("f1").alias("best_f1"),
        F.max(F.when(F.abs(F.col("threshold") - at) < 1e-12, F.col("f1"))).alias("f1_at_default"))


# E11 --------------------------------------------------------------------------------------
def subgroup_metrics(df: DataFrame, label: str, pred: str, groups: list[str]) -> DataFrame:
    """Metrics per value of each grouping column (one aggregation over the
    unpivoted groupings), with the lowest-recall group of each grouping."""
    long = (df.select(label, pred, *[F.col(g).cast("string").alias(g) for g in groups])
            .unpivot([label, pred], groups, "grouping", "value"))
    m = classification_metrics(long, label, pred, ["grouping", "value"])
    least = with_totals(m, "grouping", len(groups), _least=F.min("recall"))
    return least.withColumn("lowest_recall", F.col("recall") == F.col("_least")).select(
        "grouping", "value", "n", "accuracy", "precision", "recall", "f1", "lowest_recall")


# E12 / A17 --------------------------------------------------------------------------------
def error_composition(df: DataFrame, label: str, pred: str, groups: list[str]) -> DataFrame:
    """Counts of false positives / negatives by group value, zero cells
    included, and the share of each group value within all rows, FP, FN."""
    y, p = F.col(label), F.col(pred)
    kind = F.when((y == 0) & (p == 1), "FP").when((y == 1) & (p == 0), "FN")
    long = (df.select(kind.alias("set"), *[F.col(g).cast("string").alias(g) for g in groups])
            .unpivot(["set"], groups, "grouping", "value"))
    every = long.groupBy("grouping", "value").agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("set") == "FP").alias("n_fp"),
        F.count_if(F.col("set") == "FN").alias("n_fn"))
    sums = {f"_{c}": F.sum(c) for c in ("n_all", "n_fp", "n_fn")}
    return with_totals(every, "grouping", len(groups), **sums).select(
        "grouping", "value", "n_all", "n_fp", "n_fn", (F.col("n_all") / F.col("_n_all")).alias("share_all"),
        _div0(F.col("n_fp"), F.col("_n_fp")).alias("share_fp"),
        _div0(F.col("n_fn"), F.col("_n_fn")).alias("share_fn"))


def error_rows(df: DataFrame, label: str, pred: str) -> DataFrame:
    """The misclassified rows with their error type."""
    y, p = F.col(label), F.col(pred)
    return df.where(y != p).withColumn("error", F.when(p == 1, "FP").otherwise("FN"))


# E13 / E15 --------------------------------------------------------------------------------
def worst_errors(df: DataFrame, label: str, pred: str, score: str, key: str, top_n: int = 8) -> DataFrame:
    """The ``top_n`` most confidently wrong rows (margin = 1 - p for label 1,
    p for label 0); ties by key. Distributed top-k."""
    margin = F.when(F.col(label) == 1, 1 - F.col(score)).otherwise(F.col(score))
    return (df.where(F.col(label) != F.col(pred)).withColumn("miss_margin", margin)
            .orderBy(F.col("miss_margin").desc(), F.col(key)).limit(top_n))


def extreme_cases(df: DataFrame, label: str, pred: str, score: str, key: str) -> DataFrame:
    """Highest-scored true positive and false positive, lowest-scored true
    negative and false negative (ties to the smallest key)."""
    y, p, s, k = F.col(label), F.col(pred), F.col(score), F.col(key)
    cell = (F.when((y == 1) & (p == 1), "best_true_positive").when((y == 0) & (p == 0), "surest_true_negative")
            .when((y == 0) & (p == 1), "top_false_positive").otherwise("top_false_negative"))
    high = cell.isin("best_true_positive", "top_false_positive")
    tagged = df.select(cell.alias("case"), k.alias("id"), s.alias("score"), high.alias("_high"))
    return tagged.groupBy("case").agg(
        F.min_by(F.struct("id", "score"),
                 F.struct(F.when(F.col("_high"), -F.col("score")).otherwise(F.col("score")), F.col("id")))
        .alias("r")).select("case", "r.id", "r.score")


# E14 --------------------------------------------------------------------------------------
def metric_intervals(point: DataFrame, intervals: DataFrame) -> DataFrame:
    """Point metric with clipped lower / upper error bars and width.
    ``point``: (model, metric, value); ``intervals``: bootstrap output."""
    j = point.join(intervals, ["model", "metric"])
    return j.select("model", "metric", "value", "lower", "upper",
                    F.greatest(F.lit(0.0), F.col("value") - F.col("lower")).alias("err_low"),
                    F.greatest(F.lit(0.0), F.col("upper") - F.col("value")).alias("err_high"),
                    (F.col("upper") - F.col("lower")).alias("width"))


def long_metrics(df: DataFrame, label: str, scores: dict[str, str], threshold: float = 0.5) -> DataFrame:
    """(model, metric, value) point metrics for several score columns."""
    parts = []
    for m, s in sorted(scores.items()):
        d = df.withColumn("_p", (F.col(s) >= threshold).cast("int"))
        cm = classification_metrics(d, label, "_p")
        auc = roc_auc(df, label, s).select("auc")
        row = cm.crossJoin(auc)
        parts.append(row.select(F.lit(m).alias("model"), F.explode(F.array(
            *[F.struct(F.lit(k).alias("metric"), F.col(c).alias("value"))
              for k, c in (("accuracy", "accuracy"), ("precision", "precision"), ("recall", "recall"),
                           ("f1", "f1"), ("roc_auc", "auc"))])).alias("x")).select("model", "x.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
