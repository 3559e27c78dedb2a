"""Profiling queries over the ``cohort`` fixture."""

from __future__ import annotations

from strata.operators import profile as P
from strata.plans.catalog import register
from strata.plans.fixtures import cohort, oracle_with

C = oracle_with("cohort")

FACTORS = ["sex", "pclass", "embarked"]
NUMERIC = ["age", "fare", "sibsp", "parch"]
COLS = ["id", "label", "pclass", "sex", "name", "age", "sibsp", "parch", "fare", "cabin", "embarked"]
TYPES = {"id": "bigint", "label": "int", "pclass": "int", "sex": "string", "name": "string",
         "age": "double", "sibsp": "int", "parch": "int", "fare": "double", "cabin": "string",
         "embarked": "string"}


def _union(template: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


ORACLE_RATE = C + """,
long AS (
""" + _union("SELECT '{c}' AS factor, CAST({c} AS VARCHAR) AS level, label FROM cohort", FACTORS) + """
)
SELECT factor, level, count(*) AS n, avg(CAST(label AS DOUBLE)) AS rate,
       (SELECT avg(CAST(label AS DOUBLE)) FROM cohort) AS overall_rate
FROM long WHERE level IS NOT NULL GROUP BY factor, level
"""


@register("rate_by_factor", ORACLE_RATE)
def q_rate_by_factor(spark, sf):
    return P.rate_by_factor(cohort(spark, sf), FACTORS, "label")


@register("profile_overview", C + "SELECT count(*) AS n_rows, 11 AS n_cols FROM cohort")
def q_profile_overview(spark, sf):
    return P.profile_overview(cohort(spark, sf))


@register("duplicate_counts", C + """
SELECT
  (SELECT CAST(COALESCE(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM cohort
      GROUP BY id, label, pclass, sex, name, age, sibsp, parch, fare, cabin, embarked)) AS duplicate_rows,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM cohort)) AS distinct_rows,
  (SELECT CAST(COALESCE(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM cohort GROUP BY id)) AS duplicate_keys
""")
def q_duplicate_counts(spark, sf):
    return P.duplicate_counts(cohort(spark, sf), "id")


@register("missing_profile", C + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", '{TYPES[c]}' AS dtype, count(*) - count({c}) AS missing_count, "
    f"CAST(100.0 * (count(*) - count({c})) AS DOUBLE) / count(*) AS missing_pct FROM cohort"
    for c in COLS))
def q_missing_profile(spark, sf):
    return P.missing_profile(cohort(spark, sf))


@register("completeness", C + """,
prof AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col, count(*) - count({c}) AS m, "
    f"CAST(100.0 * (count(*) - count({c})) AS DOUBLE) / count(*) AS pct FROM cohort" for c in COLS) + """)
SELECT count(*) FILTER (WHERE m > 0) AS incomplete_columns,
       arg_min(col, struct_pack(a := -m, b := col)) AS worst_column,
       max(pct) AS worst_missing_pct,
       100.0 - sum(pct) / 11 AS completeness_pct
FROM prof
""")
def q_completeness(spark, sf):
    return P.completeness(cohort(spark, sf))


_NUM_LONG = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM cohort WHERE {c} IS NOT NULL" for c in NUMERIC)


@register("describe_numeric", C + f""",
long AS ({_NUM_LONG})
SELECT col AS "column", count(*) AS count, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min,
       quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q75,
       max(v) AS max
FROM long GROUP BY col
""")
def q_describe_numeric(spark, sf):
    return P.describe_numeric(cohort(spark, sf), NUMERIC)


@register("value_counts", C + """,
long AS (""" + _union("SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM cohort",
                      ["sex", "pclass", "embarked", "sibsp"]) + """)
SELECT col AS "column", value, count(*) AS n, count(*) / (SELECT count(*) FROM cohort) AS share
FROM long GROUP BY col, value
""")
def q_value_counts(spark, sf):
    return P.value_counts(cohort(spark, sf), ["sex", "pclass", "embarked", "sibsp"])


@register("target_distribution", C + """
SELECT label, count(*) AS n, count(*) / (SELECT count(*) FROM cohort) AS share
FROM cohort GROUP BY label
""")
def q_target_distribution(spark, sf):
    return P.target_distribution(cohort(spark, sf), "label")


@register("interaction_rate", C + """
SELECT sex,
  avg(CASE WHEN pclass = 1 THEN CAST(label AS DOUBLE) END) AS rate_1,
  avg(CASE WHEN pclass = 2 THEN CAST(label AS DOUBLE) END) AS rate_2,
  avg(CASE WHEN pclass = 3 THEN CAST(label AS DOUBLE) END) AS rate_3
FROM cohort GROUP BY sex
""")
def q_interaction_rate(spark, sf):
    return P.interaction_rate(cohort(spark, sf), "sex", "pclass", "label", [1, 2, 3])


@register("interaction_levels", C + """
SELECT concat_ws('_', sex, CAST(pclass AS VARCHAR)) AS sex_pclass, count(*) AS n,
       avg(CAST(label AS DOUBLE)) AS rate
FROM cohort GROUP BY 1
""")
def q_interaction_levels(spark, sf):
    return P.interaction_levels(cohort(spark, sf), "sex", "pclass", "label")


@register("contingency", C + """,
long AS (""" + _union("SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, label FROM cohort",
                      ["sex", "pclass", "embarked", "sibsp"]) + """),
cells AS (SELECT feature, level, label, count(*) AS n FROM long
          WHERE level IS NOT NULL AND label IS NOT NULL GROUP BY ALL),
grid AS (SELECT f.feature, f.level, l.label FROM (SELECT DISTINCT feature, level FROM cells) f
         CROSS JOIN (SELECT DISTINCT label FROM cells) l)
SELECT g.feature, g.level, g.label, COALESCE(c.n, 0) AS n
FROM grid g LEFT JOIN cells c USING (feature, level, label)
""")
def q_contingency(spark, sf):
    return P.contingency(cohort(spark, sf), ["sex", "pclass", "embarked", "sibsp"], "label")


@register("population_reference", C + """
SELECT quantile_cont(age, 0.5) AS age_median, quantile_cont(age, 0.25) AS age_q25,
       quantile_cont(age, 0.75) AS age_q75,
       quantile_cont(fare, 0.5) AS fare_median, quantile_cont(fare, 0.25) AS fare_q25,
       quantile_cont(fare, 0.75) AS fare_q75,
       quantile_cont(CAST(sibsp + parch + 1 AS DOUBLE), 0.5) AS family_median,
       CAST(max(sibsp + parch + 1) AS BIGINT) AS family_max
FROM cohort
""")
def q_population_reference(spark, sf):
    return P.population_reference(cohort(spark, sf), "age", "fare", "sibsp", "parch")


@register("iqr_outliers", C + f""",
long AS ({_NUM_LONG}),
q AS (SELECT col, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY col),
f AS (SELECT col, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT f.col AS "column", q1, q3, iqr, lower, upper,
       count(*) FILTER (WHERE v < lower OR v > upper) AS n_outliers, count(*) AS n,
       100.0 * count(*) FILTER (WHERE v < lower OR v > upper) / count(*) AS pct_outliers
FROM long JOIN f ON long.col = f.col GROUP BY f.col, q1, q3, iqr, lower, upper
""")
def q_iqr_outliers(spark, sf):
    return P.iqr_outliers(cohort(spark, sf), NUMERIC)


# Skewness of the symmetric count columns is exactly 0; its float noise
# (1e-17) cannot be compared by value, so the two skewed numerics are used.
SKEWED = ["age", "fare"]
_SKEW_LONG = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM cohort WHERE {c} IS NOT NULL" for c in SKEWED)


@register("skew_profile", C + f""",
long AS ({_SKEW_LONG}),
m AS (SELECT col, avg(v) AS mu, count(*) AS n, avg(ln(1 + v)) AS mu_l FROM long GROUP BY col),
c AS (SELECT long.col, n, avg(power(v - mu, 2)) AS m2, avg(power(v - mu, 3)) AS m3, avg(power(v - mu, 4)) AS m4,
             avg(power(ln(1 + v) - mu_l, 2)) AS l2, avg(power(ln(1 + v) - mu_l, 3)) AS l3
      FROM long JOIN m ON long.col = m.col GROUP BY long.col, n)
SELECT col AS "column", n, m3 / power(m2, 1.5) AS skew_pop, l3 / power(l2, 1.5) AS skew_log1p_pop,
       m4 / (m2 * m2) - 3 AS kurtosis_pop,
       CASE WHEN n > 2 THEN m3 / power(m2, 1.5) * sqrt(CAST(n AS DOUBLE) * (n - 1)) / (n - 2) END AS skew_sample
FROM c
""")
def q_skew_profile(spark, sf):
    return P.skew_profile(cohort(spark, sf), SKEWED)


@register("histogram", C + """,
r AS (SELECT min(fare) AS lo, max(fare) AS hi FROM cohort)
SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((fare - lo) / ((hi - lo) / 30)), 29) END AS INT) AS bin,
       label, count(*) AS n,
       lo + CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((fare - lo) / ((hi - lo) / 30)), 29) END AS INT) * (hi - lo) / 30 AS bin_lo
FROM cohort, r WHERE fare IS NOT NULL GROUP BY 1, 2, lo, hi
""")
def q_histogram(spark, sf):
    return P.histogram(cohort(spark, sf), "fare", 30, "label")


@register("group_moments", C + """
SELECT label, count(*) AS n, avg(fare) AS mean, stddev_samp(fare) AS std
FROM cohort WHERE fare IS NOT NULL GROUP BY label
""")
def q_group_moments(spark, sf):
    return P.group_moments(cohort(spark, sf), "label", "fare")


@register("missing_corr", C + """,
c AS (SELECT 'age' AS a, 'cabin' AS b, count(*) AS n, count(*) FILTER (WHERE age IS NULL) AS na, count(*) FILTER (WHERE cabin IS NULL) AS nb, count(*) FILTER (WHERE age IS NULL AND cabin IS NULL) AS nab FROM cohort
UNION ALL
SELECT 'age' AS a, 'embarked' AS b, count(*) AS n, count(*) FILTER (WHERE age IS NULL) AS na, count(*) FILTER (WHERE embarked IS NULL) AS nb, count(*) FILTER (WHERE age IS NULL AND embarked IS NULL) AS nab FROM cohort
UNION ALL
SELECT 'cabin' AS a, 'embarked' AS b, count(*) AS n, count(*) FILTER (WHERE cabin IS NULL) AS na, count(*) FILTER (WHERE embarked IS NULL) AS nb, count(*) FILTER (WHERE cabin IS NULL AND embarked IS NULL) AS nab FROM cohort)
SELECT a, b, (CAST(n AS DOUBLE) * nab - CAST(na AS DOUBLE) * nb)
             / sqrt(CAST(na AS DOUBLE) * (n - na) * CAST(nb AS DOUBLE) * (n - nb)) AS r
FROM c
""")
def q_missing_corr(spark, sf):
    return P.missing_corr(cohort(spark, sf), ["age", "cabin", "embarked"])


@register("missing_by_group", C + """,
long AS (""" + _union("SELECT '{c}' AS col, label, CAST({c} IS NULL AS DOUBLE) AS m FROM cohort",
                      ["age", "cabin", "embarked"]) + """)
SELECT col AS "column", label, avg(m) AS missing_rate FROM long GROUP BY col, label
""")
def q_missing_by_group(spark, sf):
    return P.missing_by_group(cohort(spark, sf), ["age", "cabin", "embarked"], "label")
