"""Paired bootstrap: draws are exactly multinomial weights, metrics equal a direct computation on them."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.operators import bootstrap as B


def table(spark, n, ties, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    a = np.round(rng.random(n) * 0.6 + 0.3 * y, ties)
    b = np.where(rng.random(n) < 0.4, 0.5, np.round(rng.random(n), 3))  # a hot score
    return spark.createDataFrame([(int(i), int(x), float(p), float(q)) for i, (x, p, q) in enumerate(zip(y, a, b))],
                                 "id long, label int, a double, b double").repartition(3)


def direct(y, s, w):
    pos, neg = w * (y == 1), w * (y == 0)
    order = np.argsort(s, kind="stable")
    u = 0.0
    for v in np.unique(s):
        u += pos[s == v].sum() * (neg[s < v].sum() + neg[s == v].sum() / 2)
    tp, fp = pos[s >= 0.5].sum(), neg[s >= 0.5].sum()
    pre, rec = (tp / (tp + fp) if tp + fp else 0.0), tp / pos.sum()
    assert len(order) == len(y)
    return {"accuracy": (tp + neg.sum() - fp) / w.sum(), "precision": pre, "recall": rec,
            "f1": 2 * pre * rec / (pre + rec) if pre + rec else 0.0, "roc_auc": u / (pos.sum() * neg.sum())}


@pytest.mark.parametrize(("n", "ties", "n_boot"), [(700, 2, 12), (40, 6, 30)])
def test_every_replicate_equals_direct_metrics(spark, monkeypatch, n, ties, n_boot):
    monkeypatch.setattr(B, "ROWS_A_SLICE", 64)  # scores and ties span slices
    rows = B.numbered(table(spark, n, ties), "label", ["a", "b"])
    draws = B.Draws(rows, n_boot, 7)
    extra = {r["row"]: r["extra"] for r in draws.extra.collect()}
    local = rows.orderBy("row").toPandas()
    lists = pa.array([extra.get(r, []) for r in local["row"]], pa.list_(pa.int32()))
    w = B.row_weights(local["row"].to_numpy(), lists, draws.salts, draws.mean)
    assert (w.sum(axis=0) == n).all() and (w >= 0).all()
    got = {(r["model"], r["replicate"], r["metric"]): r["value"] for r in B.values_of(rows, draws, ["a", "b"], 0.5).collect()}
    y = local["y"].to_numpy()
    for m, col in (("a", "s0"), ("b", "s1")):
        for r in range(n_boot):
            for metric, value in direct(y, local[col].to_numpy(), w[:, r]).items():
                assert got[m, r, metric] == pytest.approx(value, abs=1e-12)
    assert len(got) == 2 * n_boot * 5


def test_weights_are_multinomial(spark):
    """Mean 1, variance 1 - 1/n, covariance -1/n of any two rows, and Poisson-like counts of 0, 1, 2."""
    mean = 0.9
    w = B.poisson_weights(np.arange(2000), B._salts(3, np.zeros(2000, dtype=np.int64)), mean)
    for k in range(8):
        want = math.exp(-mean) * mean ** k / math.factorial(k)
        assert (w == k).mean() == pytest.approx(want, abs=5 * math.sqrt(want / w.size) + 1e-7)
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.1 and abs(np.corrcoef(w[0], w[1])[0, 1]) < 0.1
    rows = B.numbered(table(spark, 400, 3), "label", ["a"])
    draws = B.Draws(rows, 3000, 5)
    extra = {r["row"]: r["extra"] for r in draws.extra.collect()}
    ids = np.array([r["row"] for r in rows.orderBy("row").collect()])
    w = B.row_weights(ids, pa.array([extra.get(i, []) for i in ids], pa.list_(pa.int32())), draws.salts, draws.mean)
    assert (w.sum(axis=0) == 400).all()
    assert w.mean(axis=1) == pytest.approx(np.ones(400), abs=0.12)
    assert w.var(axis=1).mean() == pytest.approx(1 - 1 / 400, abs=0.01)


def test_intervals_agree_with_index_resampling(spark):
    df = table(spark, 500, 6)
    got = {(r["model"], r["metric"]): (r["lower"], r["upper"]) for r in
           B.bootstrap_ci(df, "label", {"a": "a"}, n_boot=600).collect()}
    local = df.toPandas()
    y, s, rng = local["label"].to_numpy(), local["a"].to_numpy(), np.random.default_rng(1)
    vals = [direct(y, s, np.bincount(rng.integers(0, 500, 500), minlength=500)) for _ in range(600)]
    for metric in B.METRICS:
        v = [x[metric] for x in vals]
        se = 0.2 * np.std(v)  # an end of the interval over 600 replicates
        assert got["a", metric] == pytest.approx((np.percentile(v, 2.5), np.percentile(v, 97.5)), abs=2 * se)


def test_odd_tables(spark):
    df = table(spark, 60, 2)
    nulls = df.select("id", F.when(F.col("id") < 50, F.col("label")).alias("label"),
                      F.when(F.col("id") > 2, F.col("a")).alias("a"), F.when(F.col("id") != 7, F.col("b"))
                      .otherwise(F.lit(float("nan"))).alias("b"))
    assert B.numbered(nulls, "label", ["a", "b"]).count() == 46
    assert B.bootstrap_ci(df.limit(0), "label", {"a": "a"}, n_boot=5).collect() == []
    one = df.withColumn("label", F.lit(1))
    assert B.bootstrap_ci(one, "label", {"a": "a"}, n_boot=5).collect() == []
    vals = B.bootstrap_values(df, "label", {"a": "a", "b": "b", "c": "a"}, n_boot=40)
    diff = {(r["model"], r["metric"]): r for r in B.paired_difference(vals, "a").collect()}
    assert diff["c", "roc_auc"]["lower"] == diff["c", "roc_auc"]["upper"] == 0.0  # same rows, same draws


def test_missing_draws_are_never_broadcast(spark):
    """One entry a draw: the table grows with the root of the rows times the replicates, its estimated size does not."""
    rows = B.numbered(table(spark, 300, 2), "label", ["a", "b"])
    plan = B.with_extra(rows, B.Draws(rows, 20, 3).extra)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
