"""Locally weighted regression (A16) on the rows themselves.

Rows become one row per distinct ``(x, y)``, written once. The curve is fitted
at *anchors*: of the distinct ``x`` in each of ``anchors`` equal steps of the range the
smallest, and the largest of all; between two anchors it is a straight line. Each fit
takes all rows within the distance of its ``ceil(frac * n)``-th
nearest one, found exactly by counting distances in ever finer steps. A pass reads
the written rows once for all anchors and hands on a few numbers for each; the driver
sees nothing that grows with the rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.ranks import materialize

#: Steps that a pass of ``_ranked`` divides the distances of each target into.
STEPS = 128
#: Cut-offs of Cleveland's method: a weight is 0 from the first share of the radius on, 1 below the second.
FAR, NEAR = 0.999, 0.001


def _passed(rows: DataFrame, fn: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], add=np.add) -> np.ndarray:
    """``fn(x, y, count)`` on every batch, joined by ``add`` within the tasks and then over them."""

    def run(batches):
        total = None
        for b in batches:
            got = fn(*(c.to_numpy(zero_copy_only=False).astype(np.float64) for c in b.columns))
            total = got if total is None else add(total, got)
        if total is not None:
            flat = total.reshape(-1)
            yield pa.record_batch({"i": pa.array(np.arange(len(flat))), "v": pa.array(flat)})

    merge = {np.add: F.sum, np.minimum: F.min}[add]
    got = rows.mapInArrow(run, "i long, v double").groupBy("i").agg(merge("v").alias("v")).collect()
    out = np.empty(len(got))
    for i, v in got:
        out[i] = v
    return out


def _ranked(rows: DataFrame, distance: Callable[[np.ndarray, np.ndarray], np.ndarray], ranks: np.ndarray) -> np.ndarray:
    """For each target ``t`` the value of rank ``ranks[t]`` (from 1) among ``distance(x, y)[t]`` of all rows, exactly."""
    n = len(ranks)
    top = -_passed(rows, lambda x, y, c: -distance(x, y).max(axis=1), np.minimum)
    low, high, below = np.zeros(n), top, np.zeros(n)  # the value lies in [low, high]; ``below`` rows are less than low
    while (high > low).any():
        width = (high - low) / STEPS
        edges = np.minimum(low[:, None] + width[:, None] * np.arange(STEPS + 1), high[:, None])
        edges[:, -1] = high

        def count(x, y, c, edges=edges):
            d = distance(x, y)
            out = np.zeros((n, STEPS + 1))
            for t in range(n):
                inside = (d[t] >= edges[t, 0]) & (d[t] <= edges[t, -1])
                at = np.searchsorted(edges[t], d[t][inside], "right") - 1
                out[t] += np.bincount(at, weights=c[inside], minlength=STEPS + 1)[:STEPS + 1]
            return out

        upto = below[:, None] + np.cumsum(_passed(rows, count).reshape(n, STEPS + 1), axis=1)
        step = (upto < ranks[:, None]).sum(axis=1)
        at = np.arange(n)
        below = np.where(step > 0, upto[at, np.maximum(step - 1, 0)], below)
        new_low, upper = edges[at, step], edges[at, np.minimum(step + 1, STEPS)]

        def ends(x, y, c, low=new_low, high=upper, closed=step == STEPS):
            d = distance(x, y)
            here = (d >= low[:, None]) & ((d < high[:, None]) | (closed[:, None] & (d <= high[:, None])))
            return np.stack([np.where(here, d, np.inf).min(axis=1), np.where(here, -d, np.inf).min(axis=1)])

        low, minus = _passed(rows, ends, np.minimum).reshape(2, n)
        high = -minus
    return low


def _fit(rows: DataFrame, at: np.ndarray, radius: np.ndarray, span: float, keep: Callable) -> np.ndarray:
    """Value at each anchor of the weighted line; ``keep(x, y)``: further weight of a row."""

    def sums(x, y, c):
        u = x[None, :] - at[:, None]
        d, h = np.abs(u), radius[:, None]
        with np.errstate(invalid="ignore", divide="ignore"):
            w = np.where(d <= NEAR * h, 1.0, np.where(d <= FAR * h, (1 - (d / h) ** 3) ** 3, 0.0))
        w = w * (c * keep(x, y))
        return np.stack([w.sum(axis=1), (w * u).sum(axis=1), (w * u * u).sum(axis=1), w @ y, (w * u) @ y])

    s, su, suu, sy, suy = _passed(rows, sums).reshape(5, len(at))
    with np.errstate(invalid="ignore", divide="ignore"):
        mean, spread = su / s, suu / s - (su / s) ** 2
        slope = np.where(np.sqrt(np.maximum(spread, 0)) > 0.001 * span, (suy / s - mean * sy / s) / spread, 0.0)
        return sy / s - slope * mean


def smooth_rate(df: DataFrame, x_col: str, y_col: str, frac: float = 0.35, robust: int = 3, anchors: int = 100) -> DataFrame:
    """``(x0, fitted)``: locally weighted linear fit of ``y`` on ``x`` at every anchor (all distinct ``x`` if the
    steps hold one each), with ``robust`` passes that weigh rows down by their residual (bisquare of six medians).

    Rows with a null or NaN are left out; without rows the result is empty. One distinct ``x`` gives the mean.
    """
    spark = df.sparkSession
    x, y = F.col(x_col).cast("double"), F.col(y_col).cast("double")
    rows = materialize(df.select(x.alias("x"), y.alias("y")).where("x is not null and y is not null and not isnan(x) and not isnan(y)")
                       .groupBy("x", "y").agg(F.count(F.lit(1)).alias("c")))
    n, low, high = rows.agg(F.sum("c"), F.min("x"), F.max("x")).first()
    if not n:
        return spark.createDataFrame([], "x0 double, fitted double")
    step = F.when(F.lit(high > low), F.floor((F.col("x") - low) / F.lit((high - low) / anchors or 1.0))).otherwise(F.lit(0))
    firsts = rows.groupBy(step.alias("g")).agg(F.min("x").alias("x")).collect()  # at most anchors + 1 rows
    at = np.unique(np.array([r["x"] for r in firsts] + [high], dtype=np.float64))
    k = max(2, min(n, int(frac * n + 1e-10)))
    radius = _ranked(rows, lambda x, y: np.abs(x[None, :] - at[:, None]), np.full(len(at), k, dtype=np.float64))
    fitted = _fit(rows, at, radius, high - low, lambda x, y: 1.0)
    for _ in range(robust):
        def residual(x, y, curve=fitted):
            return np.abs(y - np.interp(x, at, curve))

        middle = _ranked(rows, lambda x, y: np.stack([residual(x, y)] * 2), np.array([(n - 1) // 2 + 1, n // 2 + 1.0]))
        scale = 6.0 * float(middle.mean())
        if scale <= 0:
            break

        def keep(x, y, residual=residual, scale=scale):
            r = residual(x, y) / scale
            return np.where(r <= NEAR, 1.0, np.where(r < FAR, (1 - r * r) ** 2, 0.0))

        new = _fit(rows, at, radius, high - low, keep)
        fitted = np.where(np.isnan(new), fitted, new)  # an anchor whose rows all weigh nothing keeps its value
    return spark.createDataFrame(list(zip(at.tolist(), fitted.tolist(), strict=True)), "x0 double, fitted double")
