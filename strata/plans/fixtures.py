"""Fixture views derived from the driver tables.

The SQL text is shared by Spark and by the DuckDB oracle, so both engines
start every check from the same rows. Table names are placeholders: Spark
binds DataFrames to them (``spark.sql(text, orders=df, ...)``), the oracle
binds view names.

``cohort``: one labelled row per order with the column roles of a
passenger table (label, ordinal class, binary category, a name that carries
a title, a nullable numeric, counts, a skewed numeric, a nullable code with
a first-letter category, a nullable port code).
``scored``: ``cohort`` with two deterministic model scores (exact thousandths).
``doc_labels``: documents joined to their quality / toxicity labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.sources.tables import read_table

COHORT_SQL = """
SELECT
  o.o_orderkey AS id,
  CASE WHEN (c.c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') AND o.o_totalprice > 180000
             AND (o.o_orderkey * 17) % 10 < 9)
         OR (o.o_orderkey * 31) % 10 < 2 THEN 1 ELSE 0 END AS label,
  CASE WHEN o.o_totalprice > 350000 THEN 1 WHEN o.o_totalprice > 180000 THEN 2 ELSE 3 END AS pclass,
  CASE WHEN c.c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN 'female' ELSE 'male' END AS sex,
  'Doe, '
    || CASE WHEN o.o_orderkey < 7 THEN 'Don'
            WHEN o.o_orderkey % 400 = 9 THEN 'Capt'
            WHEN o.o_orderkey % 50 = 3 THEN 'Mlle'
            WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'Mrs'
            WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Miss'
            WHEN o.o_orderkey % 9 = 0 THEN 'Master'
            ELSE 'Mr' END
    || CASE WHEN o.o_orderkey % 700 = 5 THEN ' ' ELSE '. ' END
    || c.c_name AS name,
  CASE WHEN o.o_orderkey % 5 = 0 THEN CAST(NULL AS DOUBLE)
       ELSE CAST((o.o_custkey * 7) % 82 AS DOUBLE) END AS age,
  CAST(o.o_orderkey % 4 AS INT) AS sibsp,
  CAST(o.o_custkey % 3 AS INT) AS parch,
  o.o_totalprice AS fare,
  CASE WHEN o.o_orderkey % 4 <> 0 THEN CAST(NULL AS STRING)
       ELSE substr('ABCDEFGT', CAST(o.o_custkey % 8 AS INT) + 1, 1)
            || CAST(o.o_orderkey % 97 AS STRING) END AS cabin,
  CASE WHEN o.o_orderkey % 500 = 0 THEN CAST(NULL AS STRING)
       ELSE substr('SSSCQ', CAST(o.o_custkey % 5 AS INT) + 1, 1) END AS embarked
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

# Two deterministic "models": exact thousandths, many ties.
SCORED_SQL = """
SELECT id, label, sex, pclass,
  CAST((CASE WHEN sex = 'female' AND pclass < 3 THEN 620 ELSE 180 END) + (id * 7919) % 380 AS DOUBLE) / 1000 AS score,
  CAST((CASE WHEN sex = 'female' THEN 540 ELSE 260 END) + (id * 104729) % 430 AS DOUBLE) / 1000 AS score_b
FROM {cohort}
"""

DOC_LABELS_SQL = """
SELECT d.doc_id AS id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id
"""

def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(COHORT_SQL, orders=read_table(spark, sf_dir, "orders"),
                     customer=read_table(spark, sf_dir, "customer"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCORED_SQL, cohort=cohort(spark, sf_dir))


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DOC_LABELS_SQL, documents=read_table(spark, sf_dir, "documents"),
                     labels=read_table(spark, sf_dir, "labels"))


def oracle_with(*names: str) -> str:
    """``WITH`` prefix defining the named fixture views for the DuckDB oracle."""
    parts = []
    need = set(names)
    if "scored" in need:
        need.add("cohort")
    if "cohort" in need:
        parts.append("cohort AS (" + COHORT_SQL.format(orders="orders", customer="customer") + ")")
    if "scored" in need:
        parts.append("scored AS (" + SCORED_SQL.format(cohort="cohort") + ")")
    if "doc_labels" in need:
        parts.append("doc_labels AS (" + DOC_LABELS_SQL.format(documents="documents", labels="labels") + ")")
    return "WITH " + ",\n".join(parts) + "\n"
