"""Split, fold and sample queries (R1-R3) over the cohort."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import splits as S
from strata.plans.catalog import register
from strata.plans.fixtures import cohort, oracle_with


def split_cte(source: str = "cohort", key: str = "id", strata: str = "label",
              fraction_ppm: int = 200_000, seed: int = 42) -> str:
    """DuckDB CTEs ``hashed``, ``quota`` and ``split`` (key, split) for the
    exact-quota stratified split; same rows as ``splits.stratified_split``."""
    return f""",
hashed AS (SELECT *, CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8) AS BIGINT) AS _h
           FROM {source}),
sz AS (SELECT {strata} AS s, count(*) AS n_s FROM {source} GROUP BY {strata}),
tot AS (SELECT sum(n_s) AS n, CAST(ceil(sum(n_s) * {fraction_ppm} / 1000000.0) AS BIGINT) AS t FROM sz),
q0 AS (SELECT s, n_s, t, (t * n_s) // n AS base, (t * n_s) % n AS rem FROM sz, tot),
quota AS (SELECT s, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, s)
                                    <= t - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM q0),
split AS (SELECT h.{key} AS _key, CASE WHEN row_number() OVER (PARTITION BY h.{strata} ORDER BY _h, h.{key})
                                     <= q.quota THEN 'test' ELSE 'train' END AS split,
                 (row_number() OVER (PARTITION BY h.{strata} ORDER BY _h, h.{key}) - 1) % 5 AS fold
          FROM hashed h JOIN quota q ON h.{strata} = q.s)
"""


C = oracle_with("cohort")


@register("stratified_split", C + split_cte() + """
SELECT c.id, c.label, s.split FROM cohort c JOIN split s ON c.id = s._key
""")
def q_stratified_split(spark, sf):
    return S.stratified_split(cohort(spark, sf), "id", "label").select("id", "label", "split")


@register("split_sizes", C + split_cte() + """
SELECT c.label, s.split, count(*) AS n FROM cohort c JOIN split s ON c.id = s._key GROUP BY ALL
""")
def q_split_sizes(spark, sf):
    return (S.stratified_split(cohort(spark, sf), "id", "label")
            .groupBy("label", "split").agg(F.count(F.lit(1)).alias("n")))


@register("stratified_folds", C + split_cte() + """
SELECT c.id, c.label, CAST(s.fold AS INT) AS fold FROM cohort c JOIN split s ON c.id = s._key
""")
def q_stratified_folds(spark, sf):
    return S.stratified_folds(cohort(spark, sf), "id", "label", 5).select("id", "label", "fold")


@register("ordered_folds", C + """
SELECT id, label, CAST(floor((row_number() OVER (PARTITION BY label ORDER BY id) - 1) * 5
                             / count(*) OVER (PARTITION BY label)) AS INT) AS fold FROM cohort
""")
def q_ordered_folds(spark, sf):
    """R2, unshuffled: folds in key order."""
    return S.ordered_folds(cohort(spark, sf), "id", "label", 5).select("id", "label", "fold")


@register("hash_sample", C + """
SELECT id, label, fare FROM cohort
ORDER BY CAST('0x' || substr(md5(CAST(id AS VARCHAR) || '|42'), 1, 8) AS BIGINT), id LIMIT 500
""")
def q_hash_sample(spark, sf):
    return S.hash_sample(cohort(spark, sf), "id", 500).select("id", "label", "fare")
