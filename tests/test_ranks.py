import numpy as np
from pyspark.sql import functions as F

from strata.functions import ranks as R
from strata.operators import splits as S
from strata.plans.fixtures import cohort, scored
from tests.conftest import SF001


def brute_auc(y, s):
    pos = s[y == 1][:, None]
    neg = s[y == 0][None, :]
    return ((pos > neg).sum() + 0.5 * (pos == neg).sum()) / (pos.size * neg.size)


def test_auc_matches_brute_force_and_partition_count(spark):
    df = scored(spark, SF001)
    pdf = df.select("label", "score").toPandas()
    want = brute_auc(pdf["label"].to_numpy(), pdf["score"].to_numpy())
    for parts in (1, 3, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = R.rank_sum_auc(df.repartition(parts), "label", "score").first()["auc"]
        assert abs(got - want) < 1e-12
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_exact_quantiles_match_numpy(spark):
    df = cohort(spark, SF001)
    got = {r["p"]: r["value"] for r in R.exact_quantiles(df, "fare", [0.1, 0.25, 0.5, 0.9]).collect()}
    fares = df.select("fare").toPandas()["fare"].to_numpy()
    for p, v in got.items():
        assert abs(v - np.percentile(fares, p * 100)) < 1e-9


def test_midranks_average_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,)], "v double")
    got = {r["v"]: r["midrank"] for r in R.midranks(df, "v").collect()}
    assert got == {1.0: 1.0, 2.0: 2.5, 3.0: 4.0}


def test_split_sizes_are_exact(spark):
    df = cohort(spark, SF001)
    n = df.count()
    sp = S.stratified_split(df, "id", "label")
    counts = {(r["label"], r["split"]): r["count"] for r in sp.groupBy("label", "split").count().collect()}
    test = sum(v for (lab, s), v in counts.items() if s == "test")
    assert test == int(np.ceil(0.2 * n))
    assert sp.count() == n
    folds = S.stratified_folds(df, "id", "label", 5).groupBy("fold").count().collect()
    sizes = sorted(r["count"] for r in folds)
    assert sizes[-1] - sizes[0] <= 2


def test_label_encode_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "x string")
    from strata.operators.features import label_encode
    got = {r["x"]: r["x_code"] for r in label_encode(df, "x").collect()}
    assert got == {"a": 0, "b": 1, "c": 2, None: None}


def test_quantiles_do_not_depend_on_buckets(spark):
    df = scored(spark, SF001)
    got = [sorted(r["value"] for r in R.exact_quantiles(df, "score", [0.1, 0.5, 0.9], n_buckets=n).collect())
           for n in (None, 1, 7, 64)]
    assert got == [got[0]] * 4
    names = cohort(spark, SF001).select("name").distinct().withColumn("cnt", F.lit(1))
    codes = {r["name"]: r["cum_cnt"] for r in R.cumulative(names, "name", ["cnt"], n_buckets=13).collect()}
    assert [codes[n] for n in sorted(codes)] == list(range(1, len(codes) + 1))


def test_cumulative_random_ties_any_partitioning(spark):
    """Running counts per group equal numpy's for any number of partitions and buckets."""
    rng = np.random.default_rng(7)
    vals = rng.integers(0, 50, size=600).astype(float)
    grp = rng.integers(0, 3, size=600)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], "g int, v double")
    counts = R.label_counts(df, "v", None, ["g"])
    up, down = {}, {}
    for g in range(3):
        u, c = np.unique(vals[grp == g], return_counts=True)
        up.update({(g, float(x)): int(s) for x, s in zip(u, np.cumsum(c))})
        down.update({(g, float(x)): int(s) for x, s in zip(u[::-1], np.cumsum(c[::-1]))})
    for parts, buckets in ((1, 9), (5, 40), (3, None)):
        for want, desc in ((up, False), (down, True)):
            got = R.cumulative(counts.repartition(parts), "v", ["cnt"], ["g"], descending=desc, n_buckets=buckets)
            assert {(r["g"], r["v"]): r["cum_cnt"] for r in got.collect()} == want


def test_two_million_distinct_values_in_64_buckets(spark):
    n = 2_000_000
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("v"))
    cum = R.cumulative(R.label_counts(df, "v"), "v", ["cnt"], n_buckets=64)
    r = cum.agg(F.count("*").alias("n"), F.countDistinct("_bucket").alias("b"), F.max("tot_cnt").alias("t"),
                F.count_if(F.col("cum_cnt") != F.col("v") + 1).alias("wrong")).first()
    assert (r["n"], r["t"], r["wrong"]) == (n, n, 0) and r["b"] > 50
    assert R.release(spark) > 0
