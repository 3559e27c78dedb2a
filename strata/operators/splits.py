"""Splits, folds and samples.

Row choice depends only on a portable hash of the key (first 32 bits of
``md5(key|seed)``), never on ``rand()`` or partition ids, so a re-run or a
lost executor reproduces the same rows, and DuckDB computes the same hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.ranks import cumulative

LOW_BITS = 16  # buckets of h >> 16: 65 536 per stratum, ~n_s / 65 536 rows each


def key_hash(key: Column | str, seed: int | str = 42) -> Column:
    """Unsigned 32-bit hash of ``key``: first 8 hex digits of md5(key|seed)."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _quotas_from_sizes(sizes: DataFrame, strata_col: str, fraction: float) -> DataFrame:
    """Test rows per stratum from a (stratum, n_s) table: total
    ceil(fraction * n), split by largest remainder (integer arithmetic; ties
    to the smaller stratum value). One row per stratum."""
    total = sizes.agg(F.sum("n_s").alias("n"))
    num, den = int(round(fraction * 1_000_000)), 1_000_000
    t = F.ceil(F.col("n") * F.lit(num) / F.lit(den)).cast("long")  # exact for decimal fractions
    q = (sizes.crossJoin(total).withColumn("t_total", t)
         .withColumn("prod", F.col("t_total").cast("decimal(19,0)") * F.col("n_s").cast("decimal(19,0)"))
         .withColumn("base", F.expr("prod div n"))  # the product passes 2^63 at about 1e10 rows
         .withColumn("rem", F.col("prod") % F.col("n").cast("decimal(19,0)")))
    w = Window.orderBy(F.col("rem").desc(), F.col(strata_col).asc())  # strata table: few rows
    left = F.col("t_total") - F.sum("base").over(Window.partitionBy(F.lit(0)))
    return (q.withColumn("_r", F.row_number().over(w))
            .withColumn("quota", F.col("base") + F.when(F.col("_r") <= left, 1).otherwise(0))
            .select(strata_col, "n_s", "quota"))


def stratum_quotas(df: DataFrame, strata_col: str, fraction: float) -> DataFrame:
    sizes = df.groupBy(strata_col).agg(F.count(F.lit(1)).alias("n_s"))
    return _quotas_from_sizes(sizes, strata_col, fraction)


def stratified_split(df: DataFrame, key: str, strata_col: str, test_fraction: float = 0.2,
                     seed: int = 42, out_col: str = "split") -> DataFrame:
    """Exact-quota stratified split; adds ``split`` = 'test' / 'train'.

    Test rows of a stratum are its ``quota`` smallest ``(hash, key)``. The
    cut is found by counting, never by sorting a stratum in one task:
    counts per (stratum, hash >> 16) locate the boundary bucket (about
    n_s / 2^16 rows), and only that bucket is ranked.
    """
    from strata.functions.ranks import materialize

    # (stratum, key, hash) written once: the counting passes below read this
    # narrow table instead of re-running the upstream plan (joins, scans)
    h = materialize(df.select(strata_col, key).withColumn("_h", key_hash(key, seed))
                    .withColumn("_hi", F.shiftright("_h", LOW_BITS)))
    c1 = h.groupBy(strata_col, "_hi").agg(F.count(F.lit(1)).alias("c"))
    quotas = _quotas_from_sizes(c1.groupBy(strata_col).agg(F.sum("c").alias("n_s")),
                                strata_col, test_fraction)
    q = F.broadcast(quotas.where(F.col("quota") > 0).select(strata_col, "quota"))  # one row per stratum
    w = (Window.partitionBy(strata_col).orderBy("_hi")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    b1 = (c1.join(q, strata_col).withColumn("_cum", F.sum("c").over(w))
          .where((F.col("_cum") >= F.col("quota")) & (F.col("_cum") - F.col("c") < F.col("quota")))
          .select(strata_col, F.col("_hi").alias("_hi_star"),
                  (F.col("quota") - (F.col("_cum") - F.col("c"))).alias("_left")))
    wk = Window.partitionBy(strata_col).orderBy("_h", key)
    cut = (h.join(F.broadcast(b1), strata_col).where(F.col("_hi") == F.col("_hi_star"))
           .withColumn("_rk", F.row_number().over(wk))
           .where(F.col("_rk") == F.col("_left"))
           .select(strata_col, F.col("_h").alias("_h_star"), F.col(key).alias("_k_star")))
    is_test = (F.col("_h") < F.col("_h_star")) | (
        (F.col("_h") == F.col("_h_star")) & (F.col(key) <= F.col("_k_star")))
    return (df.withColumn("_h", key_hash(key, seed))
            .join(F.broadcast(cut), strata_col, "left")  # one row per stratum
            .withColumn(out_col, F.when(F.coalesce(is_test, F.lit(False)), "test").otherwise("train"))
            .drop("_h", "_h_star", "_k_star"))


def hash_rank(df: DataFrame, key: str, strata_col: str | None = None, seed: int = 42,
              out_col: str = "rank") -> DataFrame:
    """1-based rank of each row by (hash(key), key) within its stratum,
    via bucketed prefix sums (no window over a whole stratum)."""
    groups = [strata_col] if strata_col else []
    h = df.withColumn("_h", key_hash(key, seed))
    counts = h.groupBy(*groups, "_h").agg(F.count(F.lit(1)).alias("cnt"))
    cum = cumulative(counts, "_h", ["cnt"], groups).select(
        *groups, "_h", (F.col("cum_cnt") - F.col("cnt")).alias("_below"))
    tie = Window.partitionBy(*groups, "_h").orderBy(key)  # rows sharing one hash: a handful
    return (h.join(cum, [*groups, "_h"])
            .withColumn(out_col, F.col("_below") + F.row_number().over(tie))
            .drop("_h", "_below"))


def stratified_folds(df: DataFrame, key: str, strata_col: str, k: int = 5, seed: int = 42,
                     out_col: str = "fold") -> DataFrame:
    """R2: stratified k folds, shuffled by the key hash: fold = (rank - 1) mod k."""
    ranked = hash_rank(df, key, strata_col, seed, "_rank")
    return ranked.withColumn(out_col, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def ordered_folds(df: DataFrame, key: str, strata_col: str, k: int = 5, out_col: str = "fold") -> DataFrame:
    """R2 (unshuffled): stratified folds in key order."""
    groups = [strata_col]
    counts = df.groupBy(*groups, key).agg(F.count(F.lit(1)).alias("cnt"))
    cum = cumulative(counts, key, ["cnt"], groups).select(*groups, key, "cum_cnt", "tot_cnt")
    return (df.join(cum, [*groups, key])
            .withColumn(out_col, F.floor((F.col("cum_cnt") - 1) * k / F.col("tot_cnt")).cast("int"))
            .drop("cum_cnt", "tot_cnt"))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Fixed-size sample without replacement: the n smallest
    (hash, key). Distributed top-k (TakeOrderedAndProject)."""
    return (df.withColumn("_h", key_hash(key, seed))
            .orderBy("_h", key).limit(n).drop("_h"))
