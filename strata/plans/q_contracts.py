"""Contract and row-constraint queries (V1-V3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import contracts as V
from strata.operators import features as FT
from strata.plans.catalog import register
from strata.plans.fixtures import cohort, oracle_with

C = oracle_with("cohort")

# A contract stricter than the default one (the port may not be missing).
STRICT = V.Contract(required=V.COHORT_CONTRACT.required, nullable={"age", "cabin"},
                    optional=V.COHORT_CONTRACT.optional, kinds=V.COHORT_CONTRACT.kinds)


def broken_cohort(spark, sf):
    """The cohort with three defects: a required column dropped, the label
    renamed (unexpected column), the fare delivered as text."""
    return (cohort(spark, sf).drop("sex").withColumnRenamed("label", "survived_flag")
            .withColumn("fare", F.col("fare").cast("string")))


@register("contract_report", C + """
SELECT 'sex' AS "column", 'missing' AS problem, 'must be present' AS detail
UNION ALL SELECT 'survived_flag', 'unexpected', 'not among the columns of the contract'
UNION ALL SELECT 'embarked', 'nulls', CAST(c AS VARCHAR) || ' rows without a value'
          FROM (SELECT count(*) - count(embarked) AS c FROM cohort) WHERE c > 0
UNION ALL SELECT 'fare', 'dtype', 'is string, one of f, i, u is due'
          FROM (SELECT count(fare) AS c FROM cohort) WHERE c > 0
""")
def q_contract_report(spark, sf):
    return V.contract_report(broken_cohort(spark, sf), STRICT)


def request_records(spark, sf):
    """Scoring requests derived from the cohort: raw title as sent by a
    client (may be outside the allowed set or absent)."""
    return cohort(spark, sf).select(
        "id", "pclass", "sex", "age", "sibsp", "parch", "fare", "embarked",
        F.col("cabin").isNotNull().alias("has_cabin"),
        FT.extract_title(F.col("name")).alias("title"))


REQ_SQL = f""",
req AS (SELECT id, pclass, sex, age, sibsp, parch, fare, COALESCE(embarked, 'S') AS embarked,
               COALESCE(cabin IS NOT NULL, FALSE) AS has_cabin,
               COALESCE(nullif(regexp_extract(name, ',\\s*([^\\.]+)\\.', 1), ''), 'Mr') AS title
        FROM cohort),
chk AS (SELECT id, embarked, title, concat_ws('; ',
    CASE WHEN pclass IS NULL THEN 'pclass: required' END,
    CASE WHEN pclass NOT IN (1, 2, 3) THEN 'pclass: not allowed' END,
    CASE WHEN sex IS NULL THEN 'sex: required' END,
    CASE WHEN sex NOT IN ('male', 'female') THEN 'sex: not allowed' END,
    CASE WHEN age IS NULL THEN 'age: required' END,
    CASE WHEN age < 0 THEN 'age: below 0' END,
    CASE WHEN age > 100 THEN 'age: above 100' END,
    CASE WHEN sibsp IS NULL THEN 'sibsp: required' END,
    CASE WHEN sibsp < 0 THEN 'sibsp: below 0' END,
    CASE WHEN parch IS NULL THEN 'parch: required' END,
    CASE WHEN parch < 0 THEN 'parch: below 0' END,
    CASE WHEN fare IS NULL THEN 'fare: required' END,
    CASE WHEN fare < 0 THEN 'fare: below 0' END,
    CASE WHEN embarked NOT IN ('C', 'Q', 'S') THEN 'embarked: not allowed' END,
    CASE WHEN title NOT IN ('Mr', 'Mrs', 'Miss', 'Master', 'Rare') THEN 'title: not allowed' END
  ) AS violations FROM req)
"""


@register("row_violations", C + REQ_SQL + """
SELECT id, violations, CAST(length(violations) > 0 AS INT) AS quarantined FROM chk
""")
def q_row_violations(spark, sf):
    tagged = V.row_violations(V.apply_defaults(request_records(spark, sf)))
    return tagged.select("id", F.concat_ws("; ", "violations").alias("violations"),
                         (F.size("violations") > 0).cast("int").alias("quarantined"))


@register("apply_defaults", C + REQ_SQL + "SELECT id, embarked, title FROM req")
def q_apply_defaults(spark, sf):
    return V.apply_defaults(request_records(spark, sf)).select("id", "embarked", "title")


@register("quarantine_counts", C + REQ_SQL + """
SELECT CASE WHEN length(violations) > 0 THEN 'quarantine' ELSE 'valid' END AS status, count(*) AS n
FROM chk GROUP BY 1
""")
def q_quarantine_counts(spark, sf):
    valid, bad = V.split_valid(request_records(spark, sf))
    return (valid.select(F.lit("valid").alias("status"))
            .unionByName(bad.select(F.lit("quarantine").alias("status")))
            .groupBy("status").agg(F.count(F.lit(1)).alias("n")))
