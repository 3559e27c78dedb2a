"""Scan / sink / projection queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators import profile as P
from strata.plans.catalog import register
from strata.plans.fixtures import cohort, oracle_with
from strata.plans.q_profile import FACTORS
from strata.plans.q_profile import ORACLE_RATE as RATE_SQL
from strata.session import shared_dir
from strata.sources.tables import read_csv, write_result

C = oracle_with("cohort")


@register("scan_cohort", C + """
SELECT id, label, CASE WHEN id % 50 <> 7 THEN pclass END AS pclass, CASE WHEN id % 50 <> 7 THEN sex END AS sex,
       CASE WHEN id % 50 = 11 THEN replace(name, ', ', ',' || chr(10)) WHEN id % 50 <> 7 THEN name END AS name,
       CASE WHEN id % 50 NOT IN (7, 13) THEN age END AS age, CASE WHEN id % 50 <> 7 THEN sibsp END AS sibsp,
       CASE WHEN id % 50 <> 7 THEN parch END AS parch, CASE WHEN id % 50 <> 7 THEN fare END AS fare,
       CASE WHEN id % 50 <> 7 THEN cabin END AS cabin, CASE WHEN id % 50 <> 7 THEN embarked END AS embarked,
       CASE id % 50 WHEN 3 THEN '<fields>' WHEN 7 THEN '<fields>' WHEN 13 THEN 'age' ELSE '' END AS wrong,
       CASE WHEN id % 50 IN (3, 7, 13) THEN id END AS raw_id, CASE WHEN id % 50 = 3 THEN 'extra' END AS raw_surplus
FROM cohort
""")
def q_scan_cohort(spark, sf):
    """The cohort written as CSV text (missing values as empty fields and as pandas
    tokens) in which some records have a field too many, a line end within quotes, two
    fields only or text for a number, scanned back with the explicit schema."""
    df = cohort(spark, sf)
    path = shared_dir(spark, f"csv-{uuid.uuid4().hex}")
    kind = F.col("id") % 50
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).withColumns({
        # half of the missing ports spelled as a pandas missing token
        "embarked": F.when(F.col("embarked").isNull() & (F.col("id") % 1000 == 0), "NaN").otherwise(F.col("embarked")),
        "age": F.when(kind == 13, "old").otherwise(F.col("age")),
        "name": F.when(kind == 11, F.replace("name", F.lit(", "), F.lit(",\n"))).otherwise(F.col("name"))})
    quoted = [F.coalesce(F.when(F.col(c).rlike('[,\n"]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
                         .otherwise(F.col(c)), F.lit("")) for c in df.columns]
    line = F.concat_ws(",", *quoted)
    text.select(F.when(kind == 3, F.concat(line, F.lit(",extra"))).when(kind == 7, F.concat_ws(",", "id", "label"))
                .otherwise(line).alias("line")).write.text(path)
    back = read_csv(spark, path, df.schema, multi_line=True, header=False)
    raw = F.split("_raw_record", ",")
    return back.select(*df.columns, F.concat_ws(";", "_corrupt_record").alias("wrong"),
                       F.element_at(raw, 1).cast("long").alias("raw_id"),
                       F.when(F.element_at(raw, -1).startswith("extra"), "extra").alias("raw_surplus"))


@register("result_sink", RATE_SQL)
def q_result_sink(spark, sf):
    """S3: a result table written per run as JSON and read back."""
    path = shared_dir(spark, f"results-{uuid.uuid4().hex}/rate_by_factor")
    res = P.rate_by_factor(cohort(spark, sf), FACTORS, "label")
    write_result(res, path, fmt="json")
    return spark.read.schema(res.schema).json(path)


@register("select_features", C + "SELECT id, pclass, sex, age, fare, embarked FROM cohort WHERE pclass < 3")
def q_select_features(spark, sf):
    """P1 + P3: fixed feature list in fixed order and a row filter (both
    reach the parquet scan)."""
    return cohort(spark, sf).where(F.col("pclass") < 3).select("id", "pclass", "sex", "age", "fare", "embarked")


@register("density_grid", C + """,
b AS (SELECT label, fare AS x, count(*) AS c FROM cohort WHERE fare IS NOT NULL GROUP BY 1, 2),
w AS (SELECT label, count(*) AS n, power(count(*), -0.2) * stddev_samp(fare) AS h
      FROM cohort WHERE fare IS NOT NULL GROUP BY label),
p AS (SELECT min(x) + g * (max(x) - min(x)) / 99 AS grid_x FROM b, (SELECT unnest(range(100)) AS g) GROUP BY g)
SELECT b.label, grid_x, sum(c * exp(-0.5 * power((grid_x - x) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS density
FROM b JOIN w ON b.label = w.label CROSS JOIN p GROUP BY b.label, grid_x
""")
def q_density_grid(spark, sf):
    """Kernel density of the fare per outcome on a 100-point grid."""
    return P.density_grid(cohort(spark, sf), "fare", "label")


@register("smooth_rate")
def q_smooth_rate(spark, sf):
    """Locally weighted outcome rate along the age."""
    return P.smooth_rate(cohort(spark, sf), "age", "label", 0.35)


@register("normality_ks", C + """,
v AS (SELECT fare AS x, count(*) AS cnt FROM cohort WHERE fare IS NOT NULL GROUP BY 1),
m AS (SELECT count(fare) AS n, avg(fare) AS mu, stddev_samp(fare) AS sd FROM cohort),
r AS (SELECT sum(cnt) OVER (ORDER BY x) AS upto, cnt, n, (x - mu) / sd AS z FROM v, m),
e AS (SELECT k, k * ln(2) + lgamma(k + 1) - lgamma(2 * k + 2) AS f FROM (SELECT unnest(range(150)) AS k)),
c AS (SELECT upto, cnt, n, 0.5 + sign(z) * exp(-z * z / 2) / sqrt(2 * pi())
             * sum(CASE WHEN z = 0 THEN 0 ELSE exp((2 * k + 1) * ln(abs(CASE WHEN z = 0 THEN 1 ELSE z END)) + f) END) AS p
      FROM r, e GROUP BY upto, cnt, n, z)
SELECT 'fare' AS "column", any_value(n) AS n, max(greatest(upto / n - p, p - (upto - cnt) / n)) AS statistic FROM c
""")
def q_normality_ks(spark, sf):
    """Kolmogorov-Smirnov distance of the fare from a fitted normal; its p-value is drawn, see the tests."""
    from strata.operators.stats import normality_ks
    return normality_ks(cohort(spark, sf), "fare").drop("p_value")
