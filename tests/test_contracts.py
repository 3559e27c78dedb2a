import pytest
from pyspark.sql import functions as F

from strata.operators import contracts as V
from strata.plans.fixtures import cohort
from tests.conftest import SF001


def problems(df):
    return {(r["column"], r["problem"]) for r in V.contract_report(df).collect()}


def test_clean_table_passes(spark):
    assert problems(cohort(spark, SF001)) == set()


def test_each_violation_and_all_at_once(spark):
    df = cohort(spark, SF001)
    assert problems(df.drop("sex")) == {("sex", "missing")}
    assert problems(df.withColumn("extra", F.lit(1))) == {("extra", "unexpected")}
    assert problems(df.withColumn("fare", F.col("fare").cast("string"))) == {("fare", "dtype")}
    assert ("sex", "nulls") in problems(df.withColumn("sex", F.lit(None).cast("string")))
    many = df.drop("sex", "fare").withColumn("extra", F.lit(1))
    assert problems(many) == {("sex", "missing"), ("fare", "missing"), ("extra", "unexpected")}
    with pytest.raises(ValueError) as e:
        V.assert_contract(many)
    assert "sex" in str(e.value) and "fare" in str(e.value) and "extra" in str(e.value)


def test_row_rules_and_defaults(spark):
    rows = [(1, "female", 29.0, 0, 0, 10.0, None, None, None), (4, "unknown", 29.0, 0, 0, 10.0, "S", True, "Mr"),
            (2, "male", None, 0, 0, 10.0, "C", False, "Mr"), (3, "male", 120.0, -1, 0, 10.0, "X", False, "Sir")]
    df = spark.createDataFrame(rows, "pclass int, sex string, age double, sibsp int, parch int, fare double, "
                                     "embarked string, has_cabin boolean, title string")
    valid, bad = V.split_valid(df)
    v = valid.collect()
    assert len(v) == 1 and (v[0]["embarked"], v[0]["title"], v[0]["has_cabin"]) == ("S", "Mr", False)
    reasons = {r["pclass"]: r["violations"] for r in bad.collect()}
    assert reasons[4] == ["pclass: not allowed", "sex: not allowed"]
    assert reasons[2] == ["age: required"]
    assert reasons[3] == ["age: above 100", "sibsp: below 0", "embarked: not allowed", "title: not allowed"]


def test_csv_scan_missing_tokens_and_bad_numbers(spark, tmp_path):
    from pyspark.sql import types as T

    from strata.sources.tables import read_csv
    p = tmp_path / "in.csv"
    p.write_text("id,age,sex\n1,29,female\n2,NA,male\n3,,None\n4,abc,male\n5,NaN,null\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("age", T.DoubleType()),
                           T.StructField("sex", T.StringType())])
    rows = {r["id"]: r for r in read_csv(spark, str(p), schema).collect()}
    assert rows[1]["age"] == 29.0 and rows[1]["_corrupt_record"] == []
    assert rows[2]["age"] is None and rows[2]["_corrupt_record"] == []
    assert rows[3]["age"] is None and rows[3]["sex"] is None
    assert rows[4]["age"] is None and rows[4]["_corrupt_record"] == ["age"]
    assert rows[5]["age"] is None and rows[5]["sex"] is None


def test_csv_scan_keeps_every_record(spark, tmp_path):
    from pyspark.sql import types as T

    from strata.sources.tables import read_csv
    p = tmp_path / "in.csv"
    p.write_text('id,age,name\n1,29,"Roe, Al"\n2,30,x,more\n3\n4,old,y\n5,31,"two\nlines ""q"""\n6, NA , NA \n\n7,,""\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("age", T.DoubleType()),
                           T.StructField("name", T.StringType())])
    df = read_csv(spark, str(p), schema, multi_line=True)
    rows = {r["id"]: (r["age"], r["name"], r["_corrupt_record"], r["_raw_record"]) for r in df.collect()}
    assert rows.pop(2)[:3] == (30.0, "x", ["<fields>"]) and rows.pop(3) == (None, None, ["<fields>"], "3")
    assert rows == {1: (29.0, "Roe, Al", [], None), 4: (None, "y", ["age"], "4,old,y"), 5: (31.0, 'two\nlines "q"', [], None),
                    6: (None, " NA ", ["age"], '6, NA , NA '), 7: (None, None, [], None)}
    # a record is judged by all its fields whatever is selected
    assert {r["id"] for r in df.where(F.size("_corrupt_record") > 0).select("id").collect()} == {2, 3, 4, 6}
    assert read_csv(spark, str(p), schema, multi_line=True).where("_raw_record like '2,30%'").first()["_raw_record"].strip() == "2,30,x,more"


def test_stream_quarantine_holds_rejected_rows(spark):
    from __spark_entry__ import queries

    rows = {r["violations"]: r["n"] for r in queries()["stream_quarantine"](spark, SF001).collect()}
    n_null_age = cohort(spark, SF001).where(F.col("age").isNull()).count()
    assert rows == {"age: required": n_null_age}


def test_stream_batches_have_a_manifest(spark, tmp_path):
    from strata.streaming.score import quarantined, start_scoring
    src, out, received, ckpt, manifest = (str(tmp_path / x) for x in ("in", "out", "received", "ckpt", "manifest"))
    schema = "id long, pclass int, sex string, age double, sibsp int, parch int, fare double, embarked string"
    good = [(i, 1 + i % 3, "male", 20.0 + i, 0, 0, 5.0, None) for i in range(6)]
    bad = [(10, 1, "male", 200.0, 0, 0, 5.0, "S"), (11, 9, None, 3.0, 0, 0, 5.0, "S")]

    def run():
        rules = [r for r in V.REQUEST_RULES if r.column not in ("has_cabin", "title")]
        start_scoring(spark, src, spark.createDataFrame([], schema).schema, lambda d: d.select("id", "embarked"), out, received, ckpt,
                      manifest, rules).awaitTermination()

    for rows in (good[:4], bad[:1], good[4:] + bad[1:]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        run()
    run()  # nothing new
    assert sorted(tuple(r) for r in spark.read.parquet(manifest).select("n_valid", "n_quarantined").collect()) == [(0, 1), (2, 1), (4, 0)]
    assert sorted((r["id"], r["embarked"]) for r in spark.read.parquet(out).collect()) == [(i, "S") for i in range(6)]
    assert {r["id"]: r["violations"] for r in quarantined(spark, received, manifest).collect()} == {
        10: ["age: above 100"], 11: ["pclass: not allowed", "sex: required"]}
