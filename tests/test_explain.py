import math

from pyspark.sql import functions as F

from strata.operators import explain as X
from strata.plans import q_explain as Q
from tests.conftest import SF001


def test_shap_sums_to_log_odds(spark):
    m = Q.matrix(spark, SF001)
    shap = X.linear_shap(m, m, Q.MODEL, "id")
    tot = shap.groupBy("id").agg((F.first("base") + F.sum("shap")).alias("s"))
    lo = X.batch_score(m, Q.MODEL, "id").select("id", "log_odds")
    worst = tot.join(lo, "id").agg(F.max(F.abs(F.col("s") - F.col("log_odds")))).first()[0]
    assert worst < 1e-9


def test_counterfactuals_match_brute_force(spark):
    cf, (ages, fares, fmax) = Q.counterfactual_frame(spark, SF001)
    got = {(r["id"], r["change"]): r["new_probability"] for r in cf.collect()}
    raw = Q.cohort(spark, SF001).select(*Q.RAW).toPandas()

    def prob(row):
        d = {"sex_female": float(row["sex"] == "female"), "pclass_1": float(row["pclass"] == 1),
             "pclass_2": float(row["pclass"] == 2),
             "age_10": (30.0 if row["age"] is None or math.isnan(row["age"]) else row["age"]) / 10,
             "fare_k": row["fare"] / 100000, "family_size": float(row["sibsp"] + row["parch"] + 1),
             "has_cabin": float(row["cabin"] is not None), "embarked_C": float(row["embarked"] == "C")}
        lo = Q.INTERCEPT + sum(c * d[f] for f, c in Q.COEFS)
        return 1 / (1 + math.exp(-lo))

    n = 0
    for _, row in raw.head(40).iterrows():
        for pc in (1, 2, 3):
            if row["pclass"] != pc:
                v = row.copy()
                v["pclass"] = pc
                assert abs(got[(row["id"], f"pclass:{pc}")] - prob(v)) < 1e-12
                n += 1
    assert n > 0


def test_nearest_rows_never_self(spark):
    m = Q.matrix(spark, SF001)
    q = m.orderBy("id").limit(3)
    out = X.nearest_rows(q, m, "id", [f for f, _ in Q.COEFS], k=3)
    rows = out.collect()
    assert len(rows) == 9 and all(r["query_id"] != r["neighbor_id"] for r in rows)


def test_permutation_keeps_each_value_once(spark):
    """Each (column, repeat) permutation is a bijection of the rows."""
    from strata.operators.splits import hash_rank

    df = Q.cohort(spark, SF001).select("id")
    reps = spark.createDataFrame([("sex", 0), ("sex", 1)], "column string, rep int")
    rows = df.crossJoin(reps).withColumn("_g", F.concat_ws("|", "column", F.col("rep").cast("string")))
    ranked = hash_rank(rows.withColumn("_pk", F.concat_ws("|", F.col("id").cast("string"), "_g")), "_pk", "_g")
    n = df.count()
    stats = ranked.groupBy("_g").agg(F.countDistinct("rank").alias("d"), F.min("rank").alias("lo"),
                                     F.max("rank").alias("hi")).collect()
    assert all((r["d"], r["lo"], r["hi"]) == (n, 1, n) for r in stats)


def test_permutation_importance_runs(spark):
    df = Q.cohort(spark, SF001).select(*Q.RAW)
    out = {r["column"]: r["importance"] for r in
           X.permutation_importance(df, Q.MODEL, "id", "label", ["sex", "fare"], repeats=3).collect()}
    assert set(out) == {"sex", "fare"} and out["sex"] > out["fare"] - 1e-9
