"""Streaming scoring query (M16): cohort records arrive as parquet files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators import contracts as V
from strata.operators import explain as X
from strata.plans.catalog import register
from strata.plans.fixtures import cohort, oracle_with
from strata.plans.q_contracts import REQ_SQL
from strata.plans.q_explain import C as SCORE_CTE
from strata.plans.q_explain import MODEL
from strata.session import shared_dir
from strata.streaming.score import quarantined, start_scoring

C = oracle_with("cohort")
REQUEST_COLS = ["id", "pclass", "sex", "age", "sibsp", "parch", "fare", "cabin", "embarked"]
STREAM_RULES = [r for r in V.REQUEST_RULES if r.column not in ("has_cabin", "title")]


def run_stream(spark, sf) -> dict[str, str]:
    """Write the cohort as arriving files and score them to the end; the folders of the stream."""
    base = shared_dir(spark, f"stream-{uuid.uuid4().hex}")
    paths = {x: f"{base}/{x}" for x in ("source", "scored", "received", "checkpoint", "manifest")}
    records = cohort(spark, sf).select(*REQUEST_COLS)
    records.write.parquet(paths["source"])  # arriving files, as many as the scan has tasks

    def score(valid):
        return X.batch_score(MODEL.matrix(valid, ["id"]), MODEL, "id")

    start_scoring(spark, paths["source"], records.schema, score, paths["scored"], paths["received"], paths["checkpoint"],
                  paths["manifest"], rules=STREAM_RULES, files_per_trigger=64).awaitTermination()
    return paths


@register("stream_score", SCORE_CTE + """,
ok AS (SELECT id FROM cohort WHERE age IS NOT NULL AND age >= 0 AND age <= 100 AND pclass IN (1, 2, 3)
       AND sex IN ('male', 'female') AND sibsp >= 0 AND parch >= 0 AND fare >= 0)
SELECT sc.id, log_odds, 1 / (1 + exp(-log_odds)) AS probability, CAST(log_odds > 0 AS INT) AS pred,
       'given-1' AS model_version FROM sc JOIN ok ON sc.id = ok.id
""")
def q_stream_score(spark, sf):
    """Write the records as files, score them with an availableNow
    streaming query, return the scored sink (equal to batch scoring of the
    valid rows)."""
    paths = run_stream(spark, sf)
    return spark.read.parquet(paths["scored"]).select("id", "log_odds", "probability", "pred", "model_version")


@register("stream_quarantine", C + REQ_SQL + """,
v AS (SELECT regexp_replace(violations, '(; )?title: not allowed$', '') AS violations FROM chk)
SELECT violations, count(*) AS n FROM v WHERE violations <> '' GROUP BY violations
""")
def q_stream_quarantine(spark, sf):
    """The quarantined side of the same streaming job: rows with violations."""
    paths = run_stream(spark, sf)
    return (quarantined(spark, paths["received"], paths["manifest"])
            .groupBy(F.concat_ws("; ", "violations").alias("violations")).agg(F.count(F.lit(1)).alias("n")))
