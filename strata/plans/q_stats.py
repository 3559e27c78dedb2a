"""Statistical test queries (T1-T18) over the cohort and doc_labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import stats as ST
from strata.plans.catalog import register
from strata.plans.fixtures import cohort, doc_labels, oracle_with

C = oracle_with("cohort")
CAT = ["sex", "pclass", "embarked"]
NUM = ["age", "fare", "sibsp", "parch"]
COUNTS = ["sibsp", "parch"]
CAVEATS = {"parch": "weak on its own; contributes through family size"}


def _u(template: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


def chi_sql(features: list[str], source: str = "cohort", label: str = "label") -> str:
    """CTEs ending in ``chi`` (feature, chi2, dof, n, min_expected, expected_lt5, cramers_v)."""
    return f""",
long AS ({_u(f"SELECT '{{c}}' AS feature, CAST({{c}} AS VARCHAR) AS level, {label} AS lab FROM {source}", features)}),
cells0 AS (SELECT feature, level, lab, count(*) AS n FROM long
           WHERE level IS NOT NULL AND lab IS NOT NULL GROUP BY ALL),
cells AS (SELECT f.feature, f.level, l.lab, COALESCE(c.n, 0) AS n
          FROM (SELECT DISTINCT feature, level FROM cells0) f
          CROSS JOIN (SELECT DISTINCT lab FROM cells0) l
          LEFT JOIN cells0 c ON c.feature = f.feature AND c.level = f.level AND c.lab = l.lab),
rt AS (SELECT feature, level, sum(n) AS r FROM cells GROUP BY ALL),
ct AS (SELECT feature, lab, sum(n) AS c FROM cells GROUP BY ALL),
nt AS (SELECT feature, sum(n) AS nn FROM cells GROUP BY ALL),
sh AS (SELECT feature, (SELECT count(*) FROM rt WHERE rt.feature = nt.feature) AS nr,
              (SELECT count(*) FROM ct WHERE ct.feature = nt.feature) AS nc FROM nt),
e AS (SELECT cells.feature, cells.n, CAST(rt.r AS DOUBLE) * ct.c / nt.nn AS e, (sh.nr - 1) * (sh.nc - 1) AS dof,
             nt.nn, least(sh.nr, sh.nc) AS k
      FROM cells JOIN rt ON cells.feature = rt.feature AND cells.level = rt.level
      JOIN ct ON cells.feature = ct.feature AND cells.lab = ct.lab
      JOIN nt ON cells.feature = nt.feature JOIN sh ON cells.feature = sh.feature),
chi AS (SELECT feature,
          sum(power(CASE WHEN dof = 1 THEN abs(n - e) - least(0.5, abs(n - e)) ELSE abs(n - e) END, 2) / e) AS chi2,
          CAST(any_value(dof) AS BIGINT) AS dof, CAST(any_value(nn) AS BIGINT) AS n, min(e) AS min_expected,
          bool_or(e < 5) AS expected_lt5, any_value(k) AS k
        FROM e GROUP BY feature)
"""


PB_SQL = f""",
pbl AS ({_u("SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, label FROM cohort WHERE {c} IS NOT NULL", NUM)}),
pb AS (SELECT feature, corr(CAST(label AS DOUBLE), v) AS r, count(*) AS n FROM pbl GROUP BY feature)
"""


@register("chi_square", C + chi_sql(CAT + COUNTS) + """
SELECT feature, chi2, dof, n, min_expected, expected_lt5, sqrt(chi2 / n / (k - 1)) AS cramers_v FROM chi
""")
def q_chi_square(spark, sf):
    return ST.chi_square(cohort(spark, sf), CAT + COUNTS, "label")


@register("cramers_v", oracle_with("doc_labels") + chi_sql(["lang", "source"], "doc_labels", "quality") + """
SELECT feature, chi2, sqrt(chi2 / n / (k - 1)) AS cramers_v FROM chi
""")
def q_cramers_v(spark, sf):
    return ST.chi_square(doc_labels(spark, sf), ["lang", "source"], "quality").select(
        "feature", "chi2", "cramers_v")


@register("missing_mechanism", C + """,
flags AS (SELECT CAST(age IS NULL AS INT) AS age_missing, CAST(cabin IS NULL AS INT) AS cabin_missing,
                 label, pclass FROM cohort)""" + "\nUNION ALL".join(f"""
SELECT '{t}' AS target, * FROM (WITH one AS (SELECT 1)""" + chi_sql(["age_missing", "cabin_missing"], "flags", t) + """
SELECT feature, chi2, dof, n FROM chi)""" for t in ("label", "pclass")))
def q_missing_mechanism(spark, sf):
    """Missing flags against the label and against the class."""
    df = cohort(spark, sf).select(F.col("age").isNull().cast("int").alias("age_missing"),
                                  F.col("cabin").isNull().cast("int").alias("cabin_missing"), "label", "pclass")
    parts = [ST.chi_square(df, ["age_missing", "cabin_missing"], t).select(
        F.lit(t).alias("target"), "feature", "chi2", "dof", "n") for t in ("label", "pclass")]
    return parts[0].unionByName(parts[1])


@register("point_biserial", C + PB_SQL + """
SELECT feature, r, n, r * sqrt((n - 2) / (1 - r * r)) AS t FROM pb
""")
def q_point_biserial(spark, sf):
    return ST.point_biserial(cohort(spark, sf), NUM, "label")


@register("feature_audit", C + chi_sql(CAT) + PB_SQL + """
SELECT feature, 'chi-square' AS test, chi2 AS statistic, sqrt(chi2 / n / (k - 1)) AS effect_size,
       'Cramer''s V' AS effect_label, expected_lt5 FROM chi
UNION ALL
SELECT feature, 'point-biserial', r, abs(r), '|r|', CAST(NULL AS BOOLEAN) FROM pb
""")
def q_feature_audit(spark, sf):
    return ST.feature_audit(cohort(spark, sf), CAT, NUM, "label")


@register("feature_decisions")
def q_feature_decisions(spark, sf):
    """T6/T7/T14 with p-values: decision per feature and Bonferroni (rows-only check)."""
    return ST.feature_audit(cohort(spark, sf), CAT, NUM, "label", with_p=True,
                            count_features=COUNTS, caveats=CAVEATS)


LEV_SQL = """,
base AS (SELECT label AS g, fare AS x FROM cohort WHERE fare IS NOT NULL),
med AS (SELECT g, median(x) AS m FROM base GROUP BY g),
z AS (SELECT base.g, abs(x - m) AS z FROM base JOIN med ON base.g = med.g),
per AS (SELECT g, count(*) AS nj, avg(z) AS zj FROM z GROUP BY g),
tot AS (SELECT count(*) AS nn, avg(z) AS zbar, count(DISTINCT g) AS k FROM z),
ssw AS (SELECT sum(power(z.z - per.zj, 2)) AS ssw FROM z JOIN per ON z.g = per.g),
ssb AS (SELECT sum(nj * power(zj - zbar, 2)) AS ssb FROM per, tot)
"""


@register("levene", C + LEV_SQL + """
SELECT (nn - k) / (k - 1) * ssb / ssw AS w, k - 1 AS df1, nn - k AS df2 FROM tot, ssw, ssb
""")
def q_levene(spark, sf):
    return ST.levene(cohort(spark, sf), "label", "fare")


MOM_SQL = """,
m AS (SELECT count(*) FILTER (WHERE label = 1) AS na, avg(fare) FILTER (WHERE label = 1) AS ma,
             var_samp(fare) FILTER (WHERE label = 1) AS va,
             count(*) FILTER (WHERE label = 0) AS nb, avg(fare) FILTER (WHERE label = 0) AS mb,
             var_samp(fare) FILTER (WHERE label = 0) AS vb
      FROM cohort WHERE fare IS NOT NULL)
"""


@register("t_test", C + MOM_SQL + """
SELECT (ma - mb) / sqrt(va / na + vb / nb) AS t_welch,
       power(va / na + vb / nb, 2) / (power(va / na, 2) / (na - 1) + power(vb / nb, 2) / (nb - 1)) AS df_welch,
       (ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1.0 / na + 1.0 / nb)) AS t_pooled,
       CAST(na + nb - 2 AS DOUBLE) AS df_pooled
FROM m
""")
def q_t_test(spark, sf):
    return ST.t_test(cohort(spark, sf), "label", "fare", 1, 0)


@register("t_test_auto")
def q_t_test_auto(spark, sf):
    """T8 + T9 with p-values: Welch or pooled by the Levene p (rows-only check)."""
    return ST.t_test_auto(cohort(spark, sf), "label", "fare", 1, 0)


@register("cohens_d", C + MOM_SQL + """
SELECT (ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)) AS cohens_d FROM m
""")
def q_cohens_d(spark, sf):
    return ST.cohens_d(cohort(spark, sf), "label", "fare", 1, 0)


@register("anova", C + """,
c0 AS (SELECT pclass, fare - (SELECT avg(fare) FROM cohort) AS x FROM cohort WHERE fare IS NOT NULL),
g AS (SELECT pclass, count(*) AS n, avg(x) AS d, var_pop(x) AS v FROM c0 GROUP BY pclass),
t AS (SELECT sum(n) AS nn, count(*) AS k, sum(n * d * d) AS ssb, sum(n * v) AS ssw FROM g)
SELECT (ssb / (k - 1)) / (ssw / (nn - k)) AS f, k - 1 AS df1, CAST(nn - k AS BIGINT) AS df2 FROM t
""")
def q_anova(spark, sf):
    return ST.anova(cohort(spark, sf), "pclass", "fare")


@register("normality_jb", C + """,
l AS (SELECT 'age' AS col, age AS v FROM cohort WHERE age IS NOT NULL
      UNION ALL SELECT 'fare', fare FROM cohort WHERE fare IS NOT NULL),
mu AS (SELECT col, avg(v) AS mu, count(*) AS n FROM l GROUP BY col),
c AS (SELECT l.col, any_value(n) AS n, avg(power(v - mu, 2)) AS m2, avg(power(v - mu, 3)) AS m3,
             avg(power(v - mu, 4)) AS m4 FROM l JOIN mu ON l.col = mu.col GROUP BY l.col)
SELECT col AS "column", n, n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0) AS jb
FROM c
""")
def q_normality_jb(spark, sf):
    return ST.normality_jb(cohort(spark, sf), ["age", "fare"])


@register("mann_whitney", C + """,
b AS (SELECT fare AS v, CAST(label = 1 AS INT) AS is_a FROM cohort WHERE fare IS NOT NULL AND label IN (0, 1)),
vc AS (SELECT v, count(*) AS cnt, sum(is_a) AS pos FROM b GROUP BY v),
mr AS (SELECT v, cnt, pos, sum(cnt) OVER (ORDER BY v) - cnt + (cnt + 1) / 2.0 AS midrank FROM vc),
agg AS (SELECT sum(pos * midrank) AS r_a, CAST(sum(pos) AS DOUBLE) AS na, CAST(sum(cnt - pos) AS DOUBLE) AS nb,
               sum(power(CAST(cnt AS DOUBLE), 3) - cnt) AS ties FROM mr)
SELECT r_a - na * (na + 1) / 2 AS u,
       (greatest(r_a - na * (na + 1) / 2, na * nb - (r_a - na * (na + 1) / 2)) - na * nb / 2 - 0.5)
       / sqrt(na * nb / 12 * ((na + nb + 1) - ties / ((na + nb) * (na + nb - 1)))) AS z
FROM agg
""")
def q_mann_whitney(spark, sf):
    return ST.mann_whitney(cohort(spark, sf), "label", "fare", 1, 0)


PAIRS = [("age", "fare"), ("age", "sibsp"), ("age", "parch"), ("fare", "sibsp"), ("fare", "parch"),
         ("sibsp", "parch")]


@register("pearson_matrix", C + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM cohort"
    for a, b in PAIRS))
def q_pearson_matrix(spark, sf):
    return ST.pearson_matrix(cohort(spark, sf), NUM)


def _spear(a: str, b: str) -> str:
    rk = lambda c: (f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)")
    return (f"SELECT '{a}' AS a, '{b}' AS b, corr(ra, rb) AS rho FROM "
            f"(SELECT {rk(a)} AS ra, {rk(b)} AS rb FROM cohort WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")


@register("spearman_matrix", C + "\nUNION ALL\n".join(_spear(a, b) for a, b in PAIRS))
def q_spearman_matrix(spark, sf):
    return ST.spearman_matrix(cohort(spark, sf), NUM, "id")


@register("vif", C + """,
r AS (SELECT corr(fare, CAST(sibsp AS DOUBLE)) AS r12, corr(fare, CAST(parch AS DOUBLE)) AS r13,
             corr(CAST(sibsp AS DOUBLE), CAST(parch AS DOUBLE)) AS r23
      FROM cohort WHERE fare IS NOT NULL AND sibsp IS NOT NULL AND parch IS NOT NULL),
d AS (SELECT *, 1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23 AS det FROM r)
SELECT 'fare' AS feature, (1 - r23 * r23) / det AS vif, (1 - r23 * r23) / det > 5 AS high FROM d
UNION ALL SELECT 'sibsp', (1 - r13 * r13) / det, (1 - r13 * r13) / det > 5 FROM d
UNION ALL SELECT 'parch', (1 - r12 * r12) / det, (1 - r12 * r12) / det > 5 FROM d
""")
def q_vif(spark, sf):
    return ST.vif(cohort(spark, sf), ["fare", "sibsp", "parch"])


VIF_REFERENCE = ["pclass", "sex_male", "age", "sibsp", "parch", "fare", "family_size", "is_alone", "has_cabin",
                 "fare_per_person"]


@register("vif_reference")
def q_vif_reference(spark, sf):
    """The whole collinear set with the drop-first dummy of sex; infinite factors included (rows-only)."""
    df = spark.sql(MI_SQL, cohort=cohort(spark, sf)).withColumn("sex_male", (F.col("sex") == "male").cast("int"))
    return ST.vif(df, VIF_REFERENCE)


MI_DISCRETE = ["pclass", "sex", "embarked", "has_cabin", "is_alone", "title", "deck", "age_group"]
MI_CONTINUOUS = ["age", "sibsp", "parch", "fare", "family_size", "fare_per_person"]
#: The fourteen features of the information ranking, over the cohort; shared by Spark and the oracle.
MI_SQL = """
SELECT label, CAST(pclass AS STRING) AS pclass, sex, COALESCE(embarked, 'S') AS embarked,
       CASE WHEN cabin IS NULL THEN '0' ELSE '1' END AS has_cabin,
       CASE WHEN sibsp + parch = 0 THEN '1' ELSE '0' END AS is_alone,
       CASE WHEN name LIKE '%Mrs.%' THEN 'Mrs' WHEN name LIKE '%Miss.%' THEN 'Miss' WHEN name LIKE '%Master.%' THEN 'Master'
            WHEN name LIKE '%Mr.%' THEN 'Mr' ELSE 'Rare' END AS title,
       COALESCE(substr(cabin, 1, 1), 'M') AS deck,
       CASE WHEN age IS NULL THEN 'adult' WHEN age <= 12 THEN 'child' WHEN age <= 19 THEN 'teen' WHEN age <= 59 THEN 'adult'
            ELSE 'senior' END AS age_group,
       COALESCE(age, 40.0) AS age, CAST(sibsp AS DOUBLE) AS sibsp, CAST(parch AS DOUBLE) AS parch, fare,
       CAST(sibsp + parch + 1 AS DOUBLE) AS family_size, fare / (sibsp + parch + 1) AS fare_per_person
FROM {cohort}
"""


def _psi(n: str) -> str:
    low = " + ".join(f"1.0 / ({n} + {i})" for i in range(8))
    z = f"({n} + 8.0)"
    return (f"(ln{z} - 1 / (2 * {z}) - 1 / (12 * {z} ** 2) + 1 / (120 * {z} ** 4) - 1 / (252 * {z} ** 6) "
            f"+ 1 / (240 * {z} ** 8) - 1 / (132 * {z} ** 10) - ({low}))")


def _sides(n: int) -> str:
    return ", ".join(f"x - lag(x, {i}) OVER w, lead(x, {i}) OVER w - x" for i in range(1, n + 1))


@register("mutual_information", C + ", f AS (" + MI_SQL.format(cohort="cohort") + ")" + chi_sql(MI_DISCRETE, "f") + """,
mi AS (SELECT cells.feature, cells.n, nt.nn, rt.r, ct.c FROM cells
       JOIN rt ON cells.feature = rt.feature AND cells.level = rt.level
       JOIN ct ON cells.feature = ct.feature AND cells.lab = ct.lab
       JOIN nt ON cells.feature = nt.feature WHERE cells.n > 0),
x AS (""" + _u("SELECT '{c}' AS feature, {c} AS x, label AS y FROM f WHERE {c} IS NOT NULL AND label IS NOT NULL", MI_CONTINUOUS)
          + """),
d AS (SELECT row_number() OVER () AS id, feature, x, y, count(*) OVER (PARTITION BY feature) AS nn,
             count(*) OVER (PARTITION BY feature, y) AS ny, count(*) OVER (PARTITION BY feature, x) AS here,
             list_sort(list_filter([""" + _sides(3) + """], lambda v: v IS NOT NULL))[3] AS r
      FROM x WINDOW w AS (PARTITION BY feature, y ORDER BY x)),
m AS (SELECT d.feature, d.id, d.nn, d.ny, count(*) AS m FROM d
      JOIN d e ON e.feature = d.feature AND e.x >= d.x - d.r AND e.x <= d.x + d.r
      WHERE d.r > 0 AND abs(e.x - d.x) < d.r GROUP BY ALL
      UNION ALL SELECT feature, id, nn, ny, here FROM d WHERE r = 0)
SELECT feature, sum(CAST(n AS DOUBLE) / nn * ln(CAST(n AS DOUBLE) * nn / (CAST(r AS DOUBLE) * c))) AS mi
FROM mi GROUP BY feature
UNION ALL
SELECT feature, greatest(0.0, """ + _psi("max(nn)") + " + " + _psi("3") + " - avg(" + _psi("ny") + ") - avg(" + _psi("m") + """))
FROM m GROUP BY feature
""")
def q_mutual_information(spark, sf):
    """Information of fourteen features with the label: from cells, or by three nearest neighbours."""
    df = spark.sql(MI_SQL, cohort=cohort(spark, sf))
    return ST.mutual_information(df, MI_DISCRETE, MI_CONTINUOUS, "label")


DL = oracle_with("doc_labels")


@register("doc_quality_rates", DL + """,
long AS (SELECT 'lang' AS factor, lang AS level, quality FROM doc_labels
         UNION ALL SELECT 'source', source, quality FROM doc_labels)
SELECT factor, level, count(*) AS n, avg(CAST(quality AS DOUBLE)) AS rate,
       (SELECT avg(CAST(quality AS DOUBLE)) FROM doc_labels) AS overall_rate
FROM long WHERE level IS NOT NULL GROUP BY factor, level
""")
def q_doc_quality_rates(spark, sf):
    """A6 on the second real table: document quality rate by language and source."""
    from strata.operators.profile import rate_by_factor
    return rate_by_factor(doc_labels(spark, sf), ["lang", "source"], "quality")


@register("doc_length_toxicity", DL + """
SELECT 'n_chars' AS feature, corr(CAST(toxic AS DOUBLE), CAST(n_chars AS DOUBLE)) AS r, count(*) AS n,
       corr(CAST(toxic AS DOUBLE), CAST(n_chars AS DOUBLE))
         * sqrt((count(*) - 2) / (1 - power(corr(CAST(toxic AS DOUBLE), CAST(n_chars AS DOUBLE)), 2))) AS t
FROM doc_labels WHERE n_chars IS NOT NULL AND toxic IS NOT NULL
""")
def q_doc_length_toxicity(spark, sf):
    """T4 on the second real table: point-biserial r of document length with toxicity."""
    return ST.point_biserial(doc_labels(spark, sf), ["n_chars"], "toxic")
