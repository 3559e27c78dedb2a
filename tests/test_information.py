"""Nearest-neighbour information against the estimator computed row by row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import information as I


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def plain(x, y, k=3):
    keep = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[keep], y[keep]
    out = 0.0
    for i in range(len(x)):
        same = np.sort(np.abs(np.delete(x[y == y[i]], np.flatnonzero(np.flatnonzero(y == y[i]) == i)) - x[i]))
        kk = min(k, len(same))
        d = same[kk - 1]
        m = (np.abs(x - x[i]) < d).sum() if d > 0 else (x == x[i]).sum()
        out += psi(kk) - psi(len(same) + 1) - psi(int(m))
    return max(0.0, psi(len(x)) + out / len(x))


@pytest.mark.parametrize("block", [6, 100_000])
def test_equals_row_by_row_estimator(spark, block):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 3, 240)
    y[:2] = 7, 8  # labels of one row
    y[2:5] = 9  # and of three
    cols = {"normal": rng.normal(size=240) + y, "ties": np.round(rng.normal(size=240) * 2 + y), "hot": np.where(
        rng.random(240) < 0.7, 0.0, rng.random(240)), "grid": rng.integers(0, 400, 240) * 1.0, "flat": np.ones(240)}
    df = spark.createDataFrame([(int(c), *map(float, v)) for c, *v in zip(y, *cols.values(), strict=True)],
                               "y int, " + ", ".join(f"{c} double" for c in cols)).repartition(3)
    got = {r["feature"]: r["mi"] for r in I.knn_information(df, list(cols), "y", block=block).collect()}
    for c, x in cols.items():
        assert got[c] == pytest.approx(plain(x, y), abs=1e-9), c


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(i % 2, float(i) if i % 5 else None, float("nan") if i == 3 else float(i * i % 17))
                                for i in range(60)] + [(None, 1.0, 1.0)] * 3, "y int, a double, b double")
    got = {r["feature"]: r["mi"] for r in I.knn_information(df, ["a", "b"], "y").collect()}
    for c in ("a", "b"):
        rows = [(r["y"], r[c]) for r in df.collect() if r["y"] is not None and r[c] is not None and not math.isnan(r[c])]
        y, x = map(np.array, zip(*rows, strict=True))
        assert got[c] == pytest.approx(plain(x, y), abs=1e-9)
    assert I.knn_information(df.limit(0), ["a"], "y").collect() == []
    assert I.knn_information(df.withColumn("y", F.monotonically_increasing_id()), ["a"], "y").collect() == []


def test_digamma(spark):
    got = spark.range(1, 200).select("id", I.digamma(F.col("id")).alias("p")).collect()
    assert all(r["p"] == pytest.approx(psi(r["id"]), abs=1e-12) for r in got)


def test_each_value_is_counted_and_written_once(spark, monkeypatch):
    """The ranked values are read once and so not written apart; a value is no end of its own interval."""
    from strata.operators import information as I

    written = []
    monkeypatch.setattr(I, "materialize", lambda df: written.append(df) or df)
    df = spark.createDataFrame([(i % 2, float(i * i % 37)) for i in range(80)], "y int, x double")
    assert len(I.knn_information(df, ["x"], "y").collect()) == 1
    assert len(written) == 3  # counts, rows with their intervals, running counts
