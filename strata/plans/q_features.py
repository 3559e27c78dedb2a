"""Feature queries (F1-F24, S4, S7) over the cohort."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators import features as FT
from strata.operators import splits as S
from strata.plans.catalog import register
from strata.plans.fixtures import cohort, oracle_with
from strata.plans.q_splits import split_cte
from strata.session import shared_dir

C = oracle_with("cohort")

TITLE_SQL = r"nullif(regexp_extract(name, ',\s*([^\.]+)\.', 1), '')"


def titled_cte(fit_where: str = "TRUE") -> str:
    """DuckDB CTEs: ``titled`` (raw title), ``rare`` (fitted on rows of
    ``fit_where``), ``norm`` (normalised title)."""
    return f""",
titled AS (SELECT *, {TITLE_SQL} AS raw_title FROM cohort),
rare AS (SELECT raw_title FROM titled WHERE raw_title IS NOT NULL AND ({fit_where})
         GROUP BY raw_title HAVING count(*) < 10),
norm AS (
  SELECT *, CASE WHEN m IN ('Mr', 'Mrs', 'Miss', 'Master', 'Rare') THEN m ELSE 'Rare' END AS title
  FROM (SELECT t.*, CASE WHEN r.raw_title IS NOT NULL THEN 'Rare'
                         ELSE COALESCE(CASE t.raw_title WHEN 'Mlle' THEN 'Miss' WHEN 'Ms' THEN 'Miss'
                                                        WHEN 'Mme' THEN 'Mrs' END, t.raw_title) END AS m
        FROM titled t LEFT JOIN rare r ON t.raw_title = r.raw_title) x)
"""


def _fit_all(spark, sf):
    return FT.CohortFeatures().fit(cohort(spark, sf))


@register("extract_title", C + f"SELECT id, {TITLE_SQL} AS raw_title FROM cohort")
def q_extract_title(spark, sf):
    return cohort(spark, sf).select("id", FT.extract_title(F.col("name")).alias("raw_title"))


@register("rare_values", C + f"""
SELECT {TITLE_SQL} AS value, count(*) AS n FROM cohort
WHERE {TITLE_SQL} IS NOT NULL GROUP BY 1 HAVING count(*) < 10
""")
def q_rare_values(spark, sf):
    return FT.rare_values(cohort(spark, sf), FT.extract_title(F.col("name")))


@register("normalize_category", C + titled_cte() + "SELECT id, title FROM norm")
def q_normalize_category(spark, sf):
    df = cohort(spark, sf)
    rare = [r["value"] for r in FT.rare_values(df, FT.extract_title(F.col("name")))
            .where(F.col("value").isin(FT.TITLE_CANDIDATES)).collect()]  # at most 8 values
    return df.select("id", FT.normalize_title(FT.extract_title(F.col("name")), rare).alias("title"))


@register("group_median", C + titled_cte() + "SELECT title, median(age) AS median FROM norm GROUP BY title")
def q_group_median(spark, sf):
    fitted = _fit_all(spark, sf)
    df = cohort(spark, sf).withColumn(
        "title", FT.normalize_title(FT.extract_title(F.col("name")), fitted.rare_candidates))
    return FT.group_median(df, "age", "title")


@register("impute_group_median", C + titled_cte() + """,
med AS (SELECT title, round(median(age), 2) AS med FROM norm GROUP BY title)
SELECT n.id, COALESCE(n.age, med.med, (SELECT round(median(age), 2) FROM cohort)) AS age
FROM norm n LEFT JOIN med ON n.title = med.title
""")
def q_impute_group_median(spark, sf):
    return _fit_all(spark, sf).transform(cohort(spark, sf)).select("id", "age")


@register("impute_window_median", C + titled_cte() + """
SELECT id, COALESCE(age, median(age) OVER (PARTITION BY title)) AS age FROM norm
""")
def q_impute_window_median(spark, sf):
    fitted = _fit_all(spark, sf)
    title = FT.normalize_title(FT.extract_title(F.col("name")), fitted.rare_candidates)
    return FT.impute_window_median(cohort(spark, sf), "age", title).select("id", "age")


MODE_SQL = """(SELECT embarked FROM cohort WHERE embarked IS NOT NULL GROUP BY embarked
               ORDER BY count(*) DESC, embarked LIMIT 1)"""


@register("impute_mode", C + f"SELECT id, COALESCE(embarked, {MODE_SQL}) AS embarked FROM cohort")
def q_impute_mode(spark, sf):
    df = cohort(spark, sf)
    mode = FT.mode_value(df, "embarked")
    return (df.crossJoin(F.broadcast(mode))  # one row
            .select("id", F.coalesce("embarked", "mode").alias("embarked")))


@register("impute_simple", C + f"""
SELECT id, COALESCE(age, (SELECT median(age) FROM cohort)) AS age,
       COALESCE(embarked, {MODE_SQL}) AS embarked FROM cohort
""")
def q_impute_simple(spark, sf):
    df = cohort(spark, sf)
    med = FT.exact_quantiles(df.select("age"), "age", [0.5]).select(F.col("value").alias("_med"))
    mode = FT.mode_value(df, "embarked")
    return (df.crossJoin(F.broadcast(med.crossJoin(mode)))  # one row
            .select("id", F.coalesce("age", "_med").alias("age"),
                    F.coalesce("embarked", "mode").alias("embarked")))


@register("family_features", C + """
SELECT id, CAST(cabin IS NOT NULL AS INT) AS has_cabin, sibsp + parch + 1 AS family_size,
       CAST(sibsp + parch + 1 = 1 AS INT) AS is_alone FROM cohort
""")
def q_family_features(spark, sf):
    fs = FT.family_size(F.col("sibsp"), F.col("parch"))
    return cohort(spark, sf).select("id", FT.presence_flag(F.col("cabin")).alias("has_cabin"),
                                    fs.alias("family_size"), FT.is_alone(fs).alias("is_alone"))


@register("guarded_ratio", C + """
SELECT id, fare / CAST(CASE WHEN sibsp - parch <> 0 THEN sibsp - parch ELSE 1 END AS DOUBLE) AS ratio
FROM cohort
""")
def q_guarded_ratio(spark, sf):
    return cohort(spark, sf).select(
        "id", FT.guarded_ratio(F.col("fare"), F.col("sibsp") - F.col("parch")).alias("ratio"))


@register("deck_bucket", C + """
SELECT id, CASE WHEN nullif(substr(cabin, 1, 1), '') IS NULL THEN 'U'
                WHEN substr(cabin, 1, 1) IN (SELECT DISTINCT substr(cabin, 1, 1) FROM cohort
                                             WHERE pclass < 3 AND cabin IS NOT NULL) THEN substr(cabin, 1, 1)
                ELSE 'Other' END AS deck
FROM cohort
""")
def q_deck_bucket(spark, sf):
    # known letters fitted on one part of the table, applied to all of it
    df = cohort(spark, sf)
    known = FT.fitted_levels(df.where(F.col("pclass") < 3).select(FT.first_letter(F.col("cabin")).alias("d")), "d")
    return df.select("id", FT.deck_bucket(F.col("cabin"), known).alias("deck"))


@register("age_group", C + """
SELECT id, CASE WHEN age > 0 AND age <= 12 THEN 'Child' WHEN age > 12 AND age <= 18 THEN 'Teen'
                WHEN age > 18 AND age <= 59 THEN 'Adult' WHEN age > 59 AND age <= 120 THEN 'Senior' END AS age_group
FROM cohort
""")
def q_age_group(spark, sf):
    return cohort(spark, sf).select(
        "id", FT.bin_right_closed(F.col("age"), FT.AGE_BINS, FT.AGE_LABELS).alias("age_group"))


@register("log1p_feature", C + "SELECT id, ln(1 + fare) AS fare_log FROM cohort")
def q_log1p_feature(spark, sf):
    return cohort(spark, sf).select("id", FT.log1p_feature(F.col("fare")).alias("fare_log"))


@register("coerce_numeric", C + "SELECT id, TRY_CAST(substr(cabin, 2) AS DOUBLE) AS cabin_number FROM cohort")
def q_coerce_numeric(spark, sf):
    return cohort(spark, sf).select("id", FT.coerce_numeric(F.substring("cabin", 2, 1 << 20)).alias("cabin_number"))


@register("one_hot", C + """
SELECT id, CAST(COALESCE(embarked = 'C', FALSE) AS INT) AS embarked_C,
       CAST(COALESCE(embarked = 'Q', FALSE) AS INT) AS embarked_Q,
       CAST(COALESCE(embarked = 'S', FALSE) AS INT) AS embarked_S FROM cohort
""")
def q_one_hot(spark, sf):
    df = cohort(spark, sf)
    levels = FT.fitted_levels(df, "embarked")
    return FT.one_hot(df, "embarked", levels).select("id", *[f"embarked_{lv}" for lv in levels])


@register("one_hot_sparse", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_shipdate, unnest([
             {'feature': 'l_partkey', 'value': CAST(l_partkey AS VARCHAR)}, {'feature': 'l_suppkey', 'value': CAST(l_suppkey AS VARCHAR)},
             {'feature': 'l_returnflag', 'value': l_returnflag}]) AS p FROM lineitem),
v AS (SELECT DISTINCT p.feature AS feature, p.value AS value FROM l WHERE l_shipdate < TIMESTAMP '1996-01-01' AND p.value IS NOT NULL),
c AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS code FROM v)
SELECT l_orderkey, l_linenumber, c.feature AS feature, c.value AS value, code
FROM l JOIN c ON c.feature = p.feature AND c.value = p.value
""")
def q_one_hot_sparse(spark, sf):
    """F22 with levels without bound: fitted on the line items shipped before 1996, applied to all."""
    items, cols = spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_partkey", "l_suppkey", "l_returnflag"]
    levels = FT.level_table(items.where(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp")), cols)
    return FT.one_hot_sparse(items, ["l_orderkey", "l_linenumber"], cols, levels)


@register("label_encode", C + """
SELECT id, CAST(dense_rank() OVER (ORDER BY name) - 1 AS INT) AS name_code FROM cohort
""")
def q_label_encode(spark, sf):
    return FT.label_encode(cohort(spark, sf), "name", "name_code").select("id", "name_code")


@register("standardize", C + """
SELECT id, (age - (SELECT avg(age) FROM cohort)) / (SELECT stddev_pop(age) FROM cohort) AS age_scaled,
       (fare - (SELECT avg(fare) FROM cohort)) / (SELECT stddev_pop(fare) FROM cohort) AS fare_scaled
FROM cohort
""")
def q_standardize(spark, sf):
    return FT.standardize(cohort(spark, sf), ["age", "fare"]).select("id", "age_scaled", "fare_scaled")


TRAIN = "id IN (SELECT _key FROM split WHERE split = 'train')"

FIT_TRANSFORM_SQL = C + split_cte() + titled_cte(TRAIN) + f""",
med AS (SELECT title, round(median(age), 2) AS med FROM norm WHERE {TRAIN} GROUP BY title),
overall AS (SELECT round(median(age), 2) AS med FROM cohort WHERE {TRAIN}),
mode AS (SELECT embarked AS m FROM cohort WHERE embarked IS NOT NULL AND {TRAIN}
         GROUP BY embarked ORDER BY count(*) DESC, embarked LIMIT 1),
decks AS (SELECT DISTINCT substr(cabin, 1, 1) AS d FROM cohort
          WHERE cabin IS NOT NULL AND substr(cabin, 1, 1) <> '' AND {TRAIN}),
imp AS (
  SELECT n.id, n.title, COALESCE(n.age, med.med, (SELECT med FROM overall)) AS age,
         COALESCE(n.embarked, (SELECT m FROM mode)) AS embarked,
         CAST(n.cabin IS NOT NULL AS INT) AS has_cabin,
         n.sibsp + n.parch + 1 AS family_size, n.fare, n.cabin
  FROM norm n LEFT JOIN med ON n.title = med.title)
SELECT id, title, age, embarked, has_cabin, family_size,
       CAST(family_size = 1 AS INT) AS is_alone,
       fare / CAST(CASE WHEN family_size <> 0 THEN family_size ELSE 1 END AS DOUBLE) AS fare_per_person,
       CASE WHEN nullif(substr(cabin, 1, 1), '') IS NULL THEN 'U'
            WHEN substr(cabin, 1, 1) IN (SELECT d FROM decks) THEN substr(cabin, 1, 1)
            ELSE 'Other' END AS deck,
       CASE WHEN age > 0 AND age <= 12 THEN 'Child' WHEN age > 12 AND age <= 18 THEN 'Teen'
            WHEN age > 18 AND age <= 59 THEN 'Adult' WHEN age > 59 AND age <= 120 THEN 'Senior' END AS age_group
FROM imp
"""

OUT_COLS = ["id", "title", "age", "embarked", "has_cabin", "family_size", "is_alone",
            "fare_per_person", "deck", "age_group"]


def fitted_on_train(spark, sf):
    df = cohort(spark, sf)
    train = S.stratified_split(df, "id", "label").where(F.col("split") == "train")
    return FT.CohortFeatures().fit(train), df


@register("fit_transform_all", FIT_TRANSFORM_SQL)
def q_fit_transform_all(spark, sf):
    fitted, df = fitted_on_train(spark, sf)
    return fitted.transform(df).select(*OUT_COLS)


@register("transform_all", FIT_TRANSFORM_SQL)
def q_transform_all(spark, sf):
    """The transformed table kept for reuse (persisted), then read back."""
    from strata.sources.tables import cached_view
    fitted, df = fitted_on_train(spark, sf)
    return cached_view(fitted.transform(df)).select(*OUT_COLS)


@register("state_roundtrip", C + split_cte() + titled_cte(TRAIN) + f"""
SELECT 'age_median' AS kind, title AS key, round(median(age), 2) AS value FROM norm WHERE {TRAIN} GROUP BY title
UNION ALL SELECT 'age_median_overall', NULL, round(median(age), 2) FROM cohort WHERE {TRAIN}
UNION ALL SELECT DISTINCT 'known_deck', substr(cabin, 1, 1), CAST(NULL AS DOUBLE) FROM cohort
          WHERE cabin IS NOT NULL AND {TRAIN}
UNION ALL SELECT 'rare_candidate', raw_title, CAST(NULL AS DOUBLE) FROM titled
          WHERE {TRAIN} AND raw_title IN ('Master', 'Miss', 'Mlle', 'Mme', 'Mr', 'Mrs', 'Ms', 'Rare')
          GROUP BY raw_title HAVING count(*) < 10
""")
def q_state_roundtrip(spark, sf):
    """Fit, write the state with provenance, read it back."""
    fitted, _ = fitted_on_train(spark, sf)
    path = shared_dir(spark, f"state-{uuid.uuid4().hex}")
    fitted.save(spark, path, run_id="roundtrip")
    return FT.FittedFeatures.load(spark, path).state_table(spark)
