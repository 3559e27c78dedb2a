"""Distributed prefix sums, mid-ranks and exact quantiles.

Never a window over all rows. The recipe used everywhere, at every size:

1. ``groupBy(group, value)``: one row per distinct value (map-side partial
   aggregation, so a hot value is a single row after this step).
2. These rows are range partitioned by (group, value) and written once with
   the number of their partition, ``bucket``: buckets are consecutive ranges,
   there are as many as the session has shuffle partitions, and adaptive
   execution joins those that are small. A hot group spans many of them.
3. Running sum inside ``(group, bucket)`` windows (parallel across buckets).
4. Add the total of all earlier buckets from a small offsets table (one row
   per group and bucket that has rows of it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Largest table the library broadcasts without asking (rows).
MAX_BROADCAST_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """Broadcast hint only under a proven size bound.

    With ``known_rows`` (a bound that holds by construction, e.g. groups x
    buckets) at most ``max_rows`` the table is hinted for broadcast.
    Without a bound no hint is given: adaptive execution measures the
    materialised shuffle output and switches to a broadcast join only when
    the measured size is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
    (a checked size, with the shuffle join as the fallback), without an
    extra counting job.
    """
    if known_rows is not None and known_rows <= max_rows:
        return F.broadcast(df)
    return df


def with_totals(agg: DataFrame, group: str, n_groups: int, **totals: Column) -> DataFrame:
    """Aggregates of all rows of a group beside each of its rows: joined, so the rows of one group stay in many
    tasks. ``agg``'s shuffle is read twice, its input once; the totals (one row for each of ``n_groups`` known
    names) are broadcast."""
    each = agg.groupBy(group).agg(*[c.alias(k) for k, c in totals.items()])
    return agg.join(bounded_broadcast(each, known_rows=n_groups), group)


_WRITTEN: list[str] = []


def materialize(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` (an aggregated, reused intermediate) as a table in the
    shared checkpoint folder and read it back: one job, lineage cut, later
    references (and a restarted stage after a lost executor) read the files
    instead of re-scanning the input. Never a machine-local folder.
    ``by``: a column with a folder for each of its values, so that a reader of
    few values skips the others. ``release`` deletes the tables of finished work."""
    import uuid

    from strata.session import shared_dir

    path = shared_dir(df.sparkSession, f"materialized/{uuid.uuid4().hex}")
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark) -> int:
    """Delete every table ``materialize`` wrote so far; call it when no result built on them is read any more."""
    n = 0
    while _WRITTEN:
        p = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return n


def in_ranges(counts: DataFrame, order_col: str, group_cols: list[str] | None = None,
              n_buckets: int | None = None) -> DataFrame:
    """``counts`` (one row per group and value), written in consecutive ranges
    numbered by ``_bucket``. The number is stored, so it never changes when a
    later task runs again. ``n_buckets``: ranges, if not the session's number
    of shuffle partitions."""
    keys = [*(group_cols or []), order_col]
    dealt = counts.repartitionByRange(n_buckets, *keys) if n_buckets else counts.repartitionByRange(*keys)
    return materialize(dealt.withColumn("_bucket", F.spark_partition_id()), by="_bucket")


def bucket_offsets(ranged: DataFrame, sum_cols: list[str], group_cols: list[str] | None = None,
                   descending: bool = False) -> DataFrame:
    """Per (group, bucket): the sum ``_b_<c>`` of its rows, ``_off_<c>`` of all
    buckets before it and ``tot_<c>`` of the group."""
    group_cols = list(group_cols or [])
    per_bucket = ranged.groupBy(*group_cols, "_bucket").agg(*[F.sum(c).alias(f"_b_{c}") for c in sum_cols])
    wg = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    order = F.col("_bucket").desc() if descending else F.col("_bucket")
    wprev = wg.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(
        *group_cols, "_bucket", *[f"_b_{c}" for c in sum_cols],
        *[F.coalesce(F.sum(f"_b_{c}").over(wprev), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.sum(f"_b_{c}").over(wg).alias(f"tot_{c}") for c in sum_cols])


def bucket_expr(c: Column, cuts: list) -> Column:
    """Index of the half-open interval ``[cuts[i-1], cuts[i])`` holding ``c``.

    A balanced ``CASE`` tree: log2(len(cuts)) comparisons per row, codegen
    friendly. NaN sorts above every number in Spark and lands in the last
    bucket.
    """
    numeric = not cuts or not isinstance(cuts[0], str)
    cd = c.cast("double") if numeric else c

    def tree(lo: int, hi: int) -> Column:
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(cd < F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(cuts))


def cumulative(counts: DataFrame, order_col: str, sum_cols: list[str],
               group_cols: list[str] | None = None, descending: bool = False,
               n_groups: int | None = None, n_buckets: int | None = None) -> DataFrame:
    """Running sums over a table with one row per ``(group, order value)``.

    Adds ``cum_<c>`` (inclusive running sum of ``c`` in value order) and
    ``tot_<c>`` (group total) for each ``c`` in ``sum_cols``, plus the
    internal ``_bucket`` column. ``n_groups``: known number of groups (lets
    the offsets table be broadcast under a proven bound).
    """
    ranged = in_ranges(counts, order_col, group_cols, n_buckets)
    return _running(ranged, bucket_offsets(ranged, sum_cols, group_cols, descending), order_col, sum_cols, group_cols,
                    descending, n_groups)


def _running(ranged: DataFrame, offsets: DataFrame, order_col: str, sum_cols: list[str],
             group_cols: list[str] | None, descending: bool, n_groups: int | None) -> DataFrame:
    group_cols = list(group_cols or [])
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    wrun = (Window.partitionBy(*group_cols, "_bucket").orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = ranged.withColumns({f"_run_{c}": F.sum(c).over(wrun) for c in sum_cols})
    # consecutive ranges: at most groups + buckets pairs of a group and a bucket
    known = n_groups if group_cols else 1
    bound = known + int(ranged.sparkSession.conf.get("spark.sql.shuffle.partitions")) if known else None
    joined = running.join(bounded_broadcast(offsets, known_rows=bound), on=[*group_cols, "_bucket"], how="inner")
    return joined.select(
        *ranged.columns,
        *[(F.col(f"_off_{c}") + F.col(f"_run_{c}")).alias(f"cum_{c}") for c in sum_cols],
        *[F.col(f"tot_{c}") for c in sum_cols])


def label_counts(df: DataFrame, value_col: str, label_col: str | None = None,
                 group_cols: list[str] | None = None) -> DataFrame:
    """One row per (group, distinct non-null value): ``cnt`` and, with a
    label, ``pos`` / ``neg`` counts."""
    group_cols = list(group_cols or [])
    aggs = [F.count(F.lit(1)).alias("cnt")]
    if label_col:
        aggs += [F.count_if(F.col(label_col) == 1).alias("pos"),
                 F.count_if(F.col(label_col) != 1).alias("neg")]
    return (df.where(F.col(value_col).isNotNull())
            .groupBy(*group_cols, value_col).agg(*aggs))


def midranks(df: DataFrame, value_col: str, group_cols: list[str] | None = None,
             label_col: str | None = None) -> DataFrame:
    """Distinct-value table with the average (mid) rank of each value.

    Columns: group..., value, cnt, [pos, neg], below (rows with a smaller
    value), midrank = below + (cnt + 1) / 2, n (group size).
    """
    counts = label_counts(df, value_col, label_col, group_cols)
    cum = cumulative(counts, value_col, ["cnt"], group_cols)
    return cum.select(
        *(group_cols or []), value_col, "cnt",
        *(["pos", "neg"] if label_col else []),
        (F.col("cum_cnt") - F.col("cnt")).alias("below"),
        (F.col("cum_cnt") - F.col("cnt") + (F.col("cnt") + 1) / 2.0).alias("midrank"),
        F.col("tot_cnt").alias("n"),
    )


def rank_sum_auc(df: DataFrame, label_col: str, score_col: str,
                 group_cols: list[str] | None = None) -> DataFrame:
    """ROC-AUC with ties counted one half (= Mann-Whitney U / (n1 n0)).

    Returns group..., n_pos, n_neg, u, auc.
    """
    group_cols = list(group_cols or [])
    counts = label_counts(df, score_col, label_col, group_cols)
    cum = cumulative(counts, score_col, ["neg"], group_cols)
    return (cum.groupBy(*group_cols)
            .agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
                 F.sum(F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") * 0.5)).alias("u"))
            .withColumn("auc", F.try_divide(F.col("u"), F.col("n_pos").cast("double") * F.col("n_neg"))))


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float],
                    group_cols: list[str] | None = None, n_groups: int | None = None,
                    n_buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy default, Spark
    ``percentile``, DuckDB ``quantile_cont``), nulls skipped.

    Unlike the built-in ``percentile`` aggregate, no task ever holds the
    value map of a whole group: the distinct-value counts are written once
    in ranges; the few wanted ranks (groups x probs x 2 rows) are located in
    the table of bucket totals, and only the values of the buckets that hold
    one meet them. Returns group..., p, value.
    """
    group_cols = list(group_cols or [])
    ranged = in_ranges(label_counts(df, value_col, None, group_cols), value_col, group_cols, n_buckets)
    offsets = bucket_offsets(ranged, ["cnt"], group_cols)
    each = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.lit(i).alias("p_idx")) for i, p in enumerate(probs)])
    at = F.col("p") * (F.col("tot_cnt") - 1)
    wanted = (offsets.select("*", F.inline(each))  # buckets x probs
              .withColumns({"k_lo": F.floor(at).cast("long"), "k_hi": F.ceil(at).cast("long")})
              .withColumn("frac", at - F.col("k_lo"))
              .withColumn("k", F.explode(F.array_distinct(F.array("k_lo", "k_hi"))))
              .where((F.col("k") >= F.col("_off_cnt")) & (F.col("k") < F.col("_off_cnt") + F.col("_b_cnt"))))
    known = n_groups if group_cols else 1
    wanted = bounded_broadcast(wanted.select(*group_cols, "_bucket", "p", "p_idx", "frac", "k", "k_lo", "k_hi"),
                               known_rows=2 * known * len(probs) if known else None)
    cum = _running(ranged, offsets, value_col, ["cnt"], group_cols, False, n_groups)
    hit = (cum.join(wanted, [*group_cols, "_bucket"])
           .where((F.col("k") >= F.col("cum_cnt") - F.col("cnt")) & (F.col("k") < F.col("cum_cnt")))
           .groupBy(*group_cols, "p_idx", "p", "frac")
           .agg(F.max(F.when(F.col("k") == F.col("k_lo"), F.col(value_col))).alias("v_lo"),
                F.max(F.when(F.col("k") == F.col("k_hi"), F.col(value_col))).alias("v_hi")))
    return hit.select(*group_cols, "p",
                      F.when(F.col("frac") == 0, F.col("v_lo").cast("double"))
                      .otherwise(F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * F.col("frac")).alias("value"))
