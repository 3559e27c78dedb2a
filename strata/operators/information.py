"""Mutual information of continuous columns and a label, by nearest neighbours.

For each row: the distance ``d`` to its k-th nearest row of the same label,
and ``m``, the rows of any label nearer than ``d`` (with ``d = 0``: those of
the same value), itself included. The estimate in nats is
``psi(N) + mean psi(k) - mean psi(N_label) - mean psi(m)``, at least 0.

Rows are first counted by (column, value, label), so equal values are one row
whatever their number. These are ranked within (column, label) by written
ranges and cut into blocks of ``BLOCK`` consecutive ranks; the k first and last
rows of a block are copied to the block beside it, so every window holds one
block and its halo. ``m`` is a difference of two prefix sums over all values of
the column, looked up at the ends of the interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.ranks import cumulative, materialize

BLOCK = 100_000


def digamma(n: Column) -> Column:
    """psi of a positive number: eight steps up, then the asymptotic series."""
    x = n.cast("double")
    z = x + 8
    low = sum((1 / (x + i) for i in range(1, 8)), 1 / x)
    return (F.log(z) - 1 / (2 * z) - 1 / (12 * z ** 2) + 1 / (120 * z ** 4) - 1 / (252 * z ** 6)
            + 1 / (240 * z ** 8) - 1 / (132 * z ** 10) - low)


def _distances(counts: DataFrame, k: int, block: int) -> DataFrame:
    """``(feature, y, x, n, n_label, k, d, lo, hi)``: distance to the k-th neighbour, and the open interval within it."""
    ranked = cumulative(counts.withColumn("one", F.lit(1)), "x", ["one", "n"], ["feature", "y"]).select(
        "feature", "y", "x", "n", (F.col("cum_one") - 1).alias("at"), F.col("tot_n").alias("n_label"))  # read once
    own, place = F.floor(F.col("at") / block), F.col("at") % block
    beside = F.array_compact(F.array(own, F.when((place < k) & (own > 0), own - 1), F.when(place >= block - k, own + 1)))
    rows = ranked.withColumns({"own": own, "block": F.explode(beside)})
    w = Window.partitionBy("feature", "y", "block").orderBy("x")
    steps = [(f(c, i).over(w), f("n", i).over(w)) for i in range(1, k + 1) for f, c in ((F.lag, "x"), (F.lead, "x"))]
    near = [F.struct(F.lit(0.0).alias("d"), (F.col("n") - 1).alias("c"), F.col("x").alias("v"))] + [
        F.when(v.isNotNull(), F.struct(F.abs(v - F.col("x")).alias("d"), c.alias("c"), v.alias("v"))) for v, c in steps]
    rows = (rows.withColumn("near", F.array_sort(F.array_compact(F.array(*near))))
            .where(F.col("own") == F.col("block")).withColumn("k", F.least(F.lit(k), F.col("n_label") - 1)))
    start = F.struct(F.lit(0).cast("long").alias("c"), F.lit(0.0).alias("d"))
    found = F.aggregate("near", start, lambda acc, e: F.when(acc["c"] >= F.col("k"), acc).otherwise(
        F.struct((acc["c"] + e["c"]).alias("c"), e["d"].alias("d"))))
    rows = rows.withColumn("d", found["d"])
    at_end = lambda left: F.filter("near", lambda e: (e["d"] == F.col("d")) & (
        e["v"] < F.col("x") if left else e["v"] > F.col("x")))
    # the neighbour itself is the end where it is known, so rounding cannot take it in
    return rows.select("feature", "y", "x", "n", "n_label", "k", "d",
                       F.coalesce(F.try_element_at(at_end(True), F.lit(1))["v"], F.col("x") - F.col("d")).alias("lo"),
                       F.coalesce(F.try_element_at(at_end(False), F.lit(1))["v"], F.col("x") + F.col("d")).alias("hi"))


def knn_information(df: DataFrame, continuous: list[str], label: str, k: int = 3, block: int = BLOCK) -> DataFrame:
    """``(feature, mi)`` of each column; one scan of ``df`` for all of them.

    Rows with a null or NaN value or a null label are left out of that column,
    and so are labels with a single row. A label with ``k`` rows or fewer uses
    as many neighbours as it has. A column without rows gives no row.
    """
    block = max(block, 2 * k)
    wide = df.select(F.col(label).alias("y"), *[F.col(c).cast("double").alias(c) for c in continuous])
    long = wide.unpivot(["y"], continuous, "feature", "x").where(
        F.col("y").isNotNull() & F.col("x").isNotNull() & ~F.isnan("x"))
    counts = materialize(long.groupBy("feature", "x", "y").agg(F.count("*").alias("n")))
    rows = materialize(_distances(counts, k, block).where(F.col("n_label") > 1))
    # each row once, with its value and those ends that are not its value
    here, of = F.struct(F.col("x").alias("v"), "n"), lambda c: F.when(
        F.col(c) != F.col("x"), F.struct(F.col(c).alias("v"), F.lit(0).cast("long").alias("n")))
    every = rows.select("feature", F.inline(F.array_compact(F.array(here, of("lo"), of("hi"))))).groupBy(
        "feature", "v").agg(F.sum("n").alias("n"))
    upto = materialize(cumulative(every, "v", ["n"], ["feature"]).select(
        "feature", "v", F.col("n").alias("here"), "cum_n", F.col("tot_n").alias("n_all")))
    low = upto.select("feature", F.col("v").alias("lo"), F.col("cum_n").alias("upto_lo"))
    high = upto.select("feature", F.col("v").alias("hi"), (F.col("cum_n") - F.col("here")).alias("below_hi"), "here", "n_all")
    m = F.when(F.col("d") > 0, F.col("below_hi") - F.col("upto_lo")).otherwise(F.col("here"))
    each = rows.join(low, ["feature", "lo"]).join(high, ["feature", "hi"]).withColumn(
        "term", F.col("n") * (digamma(F.col("k")) - digamma(F.col("n_label")) - digamma(m)))
    return each.groupBy("feature").agg(F.greatest(F.lit(0.0), digamma(F.first("n_all")) + F.sum("term") / F.first("n_all"))
                                       .alias("mi"))
