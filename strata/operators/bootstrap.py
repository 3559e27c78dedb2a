"""Exact paired bootstrap of classification metrics, ROC-AUC on the scores themselves.

A replicate draws n of n rows with replacement: row weights that are
multinomial. They are never shipped. Each row's weight in each replicate is
computed where it is needed from a hash of (row, replicate), as a Poisson
number of a mean a little below 1; given their total M, such numbers are
multinomial, and the ``n - M`` draws that are missing (about ``SPARE`` times
the square root of n) are drawn uniformly and told to their rows as a list.
That is exactly n draws, the same for every model (paired).

For AUC the rows are range partitioned by (model, score). A task walks over its
sorted rows and sums positive and negative weights of all replicates at once,
as arrays: a slice of rows becomes one segment for its first score, one for
its last and one for what lies between, with the pairs ordered inside it.
Segments of one score are added up over slices and tasks, so ties and hot
scores are exact, and prefix sums over the segments of a replicate add the
pairs between them. The driver sees the totals per replicate alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.ranks import materialize

SPARE = 8.0  # standard deviations of the total that the Poisson mean stays below n
ROWS_A_SLICE = 20_000
CELLS = 65_536  # weights (rows x replicates) computed at a time; they stay in the processor's cache
WORK_A_TASK = 400_000_000  # weights computed by a task
METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _thresholds(mean: float) -> np.ndarray:
    """64-bit cut points of the Poisson distribution function."""
    cuts, term, total, k = [], math.exp(-mean), 0.0, 0
    while total < 1 and term > 1e-22:
        total += term
        cuts.append(min(int(total * 2.0 ** 64), 2 ** 64 - 1))
        k += 1
        term *= mean / k
    return np.array(cuts, dtype=np.uint64)


def poisson_weights(rows: np.ndarray, salts: np.ndarray, mean: float) -> np.ndarray:
    """Weight of each row (int64) in each replicate (by its uint64 salt): rows x replicates."""
    hashed, cuts = _mix(rows.astype(np.uint64)), _thresholds(mean)
    w = np.zeros((len(rows), len(salts)), dtype=np.int32)
    step = _block_rows(len(salts))
    z, spare = (np.empty((min(step, len(rows)), len(salts)), dtype=np.uint64) for _ in range(2))
    hit = np.empty(z.shape, dtype=bool)
    for i in range(0, len(rows), step):
        m = min(step, len(rows) - i)
        x, t, h = z[:m], spare[:m], hit[:m]
        np.add(hashed[i:i + m, None], salts, out=x)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):  # _mix in place
            np.right_shift(x, np.uint64(shift), out=t)
            np.bitwise_xor(x, t, out=x)
            if factor:
                np.multiply(x, np.uint64(factor), out=x)
        few = np.zeros(x.shape, dtype=np.uint8)
        for c in cuts[:4]:
            np.greater_equal(x, c, out=h)
            np.add(few, h.view(np.uint8), out=few)
        w[i:i + m] = few
        if len(cuts) > 4:
            np.greater_equal(x, cuts[4], out=h)
            rare = np.flatnonzero(h)
            if len(rare):
                w[i:i + m].reshape(-1)[rare] = np.searchsorted(cuts, x.reshape(-1)[rare], side="right")
    return w


def _block_rows(n_boot: int) -> int:
    return max(1, CELLS // max(1, n_boot))


def _salts(seed: int, attempts: np.ndarray) -> np.ndarray:
    r = np.arange(len(attempts), dtype=np.uint64)
    return _mix(r * np.uint64(0x9E3779B97F4A7C15) + _mix(np.uint64(seed) + (attempts.astype(np.uint64) << np.uint64(40))))


class Draws:
    """Row weights of ``n_boot`` replicates of a written table ``(row, y, s0, s1, ...)``."""

    def __init__(self, rows: DataFrame, n_boot: int, seed: int) -> None:
        per_task = {r["p"]: r["n"] for r in rows.groupBy(F.shiftright("row", 33).alias("p"))
                    .agg(F.count("*").alias("n")).collect()}  # a row for each written partition
        self.n, self.seed, self.n_boot = sum(per_task.values()), seed, n_boot
        self.mean = max(0.0, 1 - SPARE / math.sqrt(self.n)) if self.n else 0.0
        self.attempts, over = np.zeros(n_boot, dtype=np.int64), np.arange(n_boot)
        while len(over) and self.n:  # totals above n (about one in 1e15) are drawn again
            self.totals = self._sums(rows)
            over = np.flatnonzero(self.totals > self.n)
            self.attempts[over] += 1
        self.extra = self._missing(rows, per_task) if self.n else None

    @property
    def salts(self) -> np.ndarray:
        return _salts(self.seed, self.attempts)

    def tasks(self, rows: int) -> int:
        return max(1, -(-rows * self.n_boot // WORK_A_TASK))

    def _sums(self, rows: DataFrame) -> np.ndarray:
        salts, mean, step = self.salts, self.mean, _block_rows(self.n_boot)

        def run(batches):
            total = np.zeros(len(salts), dtype=np.int64)
            for b in batches:
                ids = b.column(0).to_numpy()
                for i in range(0, len(ids), step):
                    total += poisson_weights(ids[i:i + step], salts, mean).sum(axis=0)
            yield pa.record_batch({"r": pa.array(np.arange(len(salts))), "m": pa.array(total)})

        sums = rows.select("row").mapInArrow(run, "r long, m long").groupBy("r").agg(F.sum("m").alias("m"))
        out = np.zeros(self.n_boot, dtype=np.int64)
        for x in sums.collect():  # a row for each replicate
            out[x["r"]] = x["m"]
        return out

    def _missing(self, rows: DataFrame, per_task: dict[int, int]) -> DataFrame:
        """``(row, extra)``: the replicates that draw the row once more, one entry for each draw."""
        parts = np.array(sorted(per_task), dtype=np.int64)
        ends = np.cumsum([per_task[p] for p in parts])
        need, n, seed = self.n - self.totals, self.n, self.seed

        def run(batches):
            for b in batches:
                for r in b.column(0).to_pylist():
                    rng = np.random.default_rng([seed, 1, r])
                    for i in range(0, int(need[r]), 1_000_000):
                        at = rng.integers(0, n, min(1_000_000, int(need[r]) - i))
                        p = np.searchsorted(ends, at, side="right")
                        row = (parts[p] << 33) + at - np.where(p > 0, ends[p - 1], 0)
                        yield pa.record_batch({"row": pa.array(row), "r": pa.array(np.full(len(row), r, dtype=np.int32))})

        spark = rows.sparkSession
        reps = spark.range(0, self.n_boot, 1, max(1, min(self.n_boot, int(need.sum()) // 1_000_000 + 1)))
        return reps.mapInArrow(run, "row long, r int").groupBy("row").agg(F.collect_list("r").alias("extra"))


def row_weights(ids: np.ndarray, extra: pa.ListArray, salts: np.ndarray, mean: float) -> np.ndarray:
    """Weights of rows in all replicates; ``extra``: the replicates that draw a row once more."""
    w = poisson_weights(ids, salts, mean)
    at = np.repeat(np.arange(len(ids)), pc.list_value_length(extra).to_numpy(zero_copy_only=False))
    np.add.at(w, (at, extra.flatten().to_numpy(zero_copy_only=False)), 1)
    return w


def numbered(df: DataFrame, label: str, scores: list[str]) -> DataFrame:
    """``(row, y, s0, s1, ...)`` written once; rows without a label or a score are left out."""
    cols = [F.col(s).cast("double") for s in scores]
    whole = F.col(label).isNotNull()
    for c in cols:
        whole &= c.isNotNull() & ~F.isnan(c)
    return materialize(df.filter(whole).select(
        F.monotonically_increasing_id().alias("row"), (F.col(label) == 1).cast("int").alias("y"),
        *[c.alias(f"s{i}") for i, c in enumerate(cols)]))


def _segments(draws: Draws, threshold: float):
    """Task over rows ``(model, score, row, y, extra)`` sorted by (model, score): segments with arrays over replicates."""
    salts, mean, n_boot = draws.salts, draws.mean, draws.n_boot
    block = _block_rows(n_boot)

    def sums(ids, extra, first):
        """Weights added up over the groups that start at ``first``, a block at a time."""
        out = np.zeros((len(first), n_boot))
        for i in range(0, len(ids), block):
            j = min(i + block, len(ids))
            g, h = np.searchsorted(first, i, side="right") - 1, np.searchsorted(first, j)
            w = row_weights(ids[i:j], extra.slice(i, j - i), salts, mean)
            out[g:h] += np.add.reduceat(w, np.maximum(first[g:h] - i, 0), axis=0)
        return out

    def of(model, score, ids, y, extra):
        order = np.lexsort((y, score))
        score, ids, y, extra = score[order], ids[order], y[order], extra.take(pa.array(order))
        at = np.r_[np.flatnonzero(np.r_[True, score[1:] != score[:-1]]), len(score)]
        k = len(at) - 1
        parts = [(0, 1, True)] + [(1, k - 1, False)] * (k > 2) + [(k - 1, k, True)] * (k > 1)
        for a, b, tie in parts:
            start, (pos, neg, tp, fp, u) = float(score[at[a]]), np.zeros((5, n_boot))
            while a < b:  # as many scores as a block holds, at least one
                c = min(b, max(a + 1, int(np.searchsorted(at, at[a] + block, side="right")) - 1))
                lo, hi = at[a], at[c]
                first = np.flatnonzero(np.r_[True, (score[lo + 1:hi] != score[lo:hi - 1]) | (y[lo + 1:hi] != y[lo:hi - 1])])
                w = sums(ids[lo:hi], extra.slice(lo, hi - lo), first)
                p, q = np.zeros((2, c - a, n_boot))
                which, one = np.searchsorted(at, lo + first, side="right") - 1 - a, y[lo + first] == 1
                p[which[one]], q[which[~one]] = w[one], w[~one]
                if not tie:  # pairs inside a segment of one score are counted when its parts have been added up
                    u += (p * (neg + np.cumsum(q, axis=0) - q / 2)).sum(axis=0)
                hit = score[at[a:c]] >= threshold
                pos, neg = pos + p.sum(axis=0), neg + q.sum(axis=0)
                tp, fp = tp + p[hit].sum(axis=0), fp + q[hit].sum(axis=0)
                a = c
            yield (model, start, tie, pos, neg, tp, fp, u)

    def run(batches):
        for b in batches:
            model, score, ids, y = (b.column(i).to_numpy() for i in range(4))
            cuts = [0, *(np.flatnonzero(model[1:] != model[:-1]) + 1).tolist(), len(model)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                for i in range(lo, hi, ROWS_A_SLICE):
                    j = min(i + ROWS_A_SLICE, hi)
                    if i == j:
                        continue
                    rows = list(of(int(model[i]), score[i:j], ids[i:j], y[i:j], b.column(4).slice(i, j - i)))
                    yield pa.record_batch([
                        pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()),
                        pa.array([r[2] for r in rows]),
                        *[pa.array([r[c] for r in rows], pa.list_(pa.float64())) for c in range(3, 8)]],
                        names=["model", "score", "tie", "pos", "neg", "tp", "fp", "u"])

    return run


def bootstrap_values(df: DataFrame, label: str, scores: dict[str, str], n_boot: int = 1000, threshold: float = 0.5,
                     seed: int = 42) -> DataFrame:
    """``(model, replicate, metric, value)`` of all replicates that hold both classes.

    ``scores``: score column of each model; every replicate weighs the rows
    alike for all of them. Rows without a label or one of the scores are
    left out; an empty table gives an empty result.
    """
    names = sorted(scores)
    rows = numbered(df, label, [scores[m] for m in names])
    return values_of(rows, Draws(rows, n_boot, seed), names, threshold)


def with_extra(rows: DataFrame, extra: DataFrame) -> DataFrame:
    """Rows with the replicates that draw them once more, always shuffled: the size of ``extra`` is estimated from the
    few rows of a range, far too low, and without the hint Spark broadcasts all of it through the driver."""
    return rows.join(extra.hint("merge"), "row", "left")


def values_of(rows: DataFrame, draws: Draws, names: list[str], threshold: float) -> DataFrame:
    spark = rows.sparkSession
    schema = "model string, replicate int, metric string, value double"
    if not draws.n:
        return spark.createDataFrame([], schema)
    long = with_extra(rows, draws.extra).select(
        "row", "y", F.coalesce("extra", F.array().cast("array<int>")).alias("extra"),
        F.posexplode(F.array(*[f"s{i}" for i in range(len(names))])).alias("model", "score"))
    parts = max(spark.sparkContext.defaultParallelism, draws.tasks(draws.n * len(names)))
    sliced = (long.select("model", "score", "row", "y", "extra").repartitionByRange(parts, "model", "score", "row")
              .sortWithinPartitions("model", "score", "row"))
    segments = sliced.mapInArrow(_segments(draws, threshold), "model int, score double, tie boolean, pos array<double>, "
                                 "neg array<double>, tp array<double>, fp array<double>, u array<double>")
    sums = ["pos", "neg", "tp", "fp", "u"]
    each = (segments.select("model", "score", "tie", F.posexplode(F.arrays_zip(*sums)).alias("replicate", "x"))
            .select("model", "score", "tie", "replicate", "x.*"))
    # slices start at a score of their own segment, so (score, tie) orders all segments of a replicate
    each = materialize(each.groupBy("model", "replicate", "score", "tie").agg(*[F.sum(c).alias(c) for c in sums]))
    before = Window.partitionBy("model", "replicate").orderBy("score", F.desc("tie")).rowsBetween(
        Window.unboundedPreceding, -1)
    inside = F.when(F.col("tie"), F.col("pos") * F.col("neg") / 2).otherwise(F.col("u"))
    each = each.withColumn("u", inside + F.col("pos") * F.coalesce(F.sum("neg").over(before), F.lit(0.0)))
    total = each.groupBy("model", "replicate").agg(*[F.sum(c).alias(c) for c in sums]).filter(
        (F.col("pos") > 0) & (F.col("neg") > 0))

    def share(a, b):
        return F.when(b > 0, a / b).otherwise(0.0)

    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    out = {"accuracy": (tp + neg - fp) / (pos + neg), "precision": share(tp, tp + fp), "recall": share(tp, pos),
           "f1": share(2 * tp, tp + fp + pos), "roc_auc": F.col("u") / (pos * neg)}
    named = F.element_at(F.array(*[F.lit(m) for m in names]), F.col("model") + 1)
    return total.select(named.alias("model"), "replicate", F.explode(F.array(
        *[F.struct(F.lit(k).alias("metric"), out[k].alias("value")) for k in METRICS])).alias("x")).select(
        "model", "replicate", "x.*")


def bootstrap_ci(df: DataFrame, label: str, scores: dict[str, str], n_boot: int = 1000, ci: float = 0.95,
                 threshold: float = 0.5, seed: int = 42) -> DataFrame:
    """``(model, metric, lower, upper, n_valid)``: paired percentile intervals of ``bootstrap_values``."""
    alpha = (1 - ci) / 2
    return (bootstrap_values(df, label, scores, n_boot, threshold, seed).groupBy("model", "metric")
            .agg(F.percentile("value", alpha).alias("lower"), F.percentile("value", 1 - alpha).alias("upper"),
                 F.count(F.lit(1)).alias("n_valid")))


def paired_difference(values: DataFrame, base: str, ci: float = 0.95) -> DataFrame:
    """``(model, metric, lower, upper, share_better)`` of each model's metric minus that of ``base`` in the same replicate."""
    of_base = values.filter(F.col("model") == base).select("replicate", "metric", F.col("value").alias("base"))
    alpha, d = (1 - ci) / 2, F.col("value") - F.col("base")
    return (values.filter(F.col("model") != base).join(of_base, ["replicate", "metric"]).groupBy("model", "metric").agg(
        F.percentile(d, alpha).alias("lower"), F.percentile(d, 1 - alpha).alias("upper"),
        F.avg((d > 0).cast("double")).alias("share_better")))
