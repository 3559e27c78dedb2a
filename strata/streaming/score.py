"""Scoring of arriving records with Structured Streaming.

readStream -> defaults (V3) -> row checks (V2) -> stateless features and
score (the fitted state and the model are literals in the plan, nothing is
recomputed from the stream). Each micro-batch is computed once: foreachBatch
writes it partitioned by ``valid``, the scored rows are read from its valid part, the rest is the
quarantine. A manifest row per batch, written last, says that the batch is whole and counts
its rows. The checkpoint folder makes the query restartable after a lost executor or driver:
finished batches are not re-scored, unfinished ones are replayed idempotently (batch id in the path).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import contracts as V


def start_scoring(spark: SparkSession, source: str, schema, score: Callable[[DataFrame], DataFrame],
                  out_path: str, received_path: str, checkpoint: str, manifest_path: str,
                  rules: list[V.Rule] | None = None, files_per_trigger: int = 1, available_now: bool = True):
    """Start the streaming scoring query; returns the StreamingQuery.

    ``received_path`` holds every row with its ``violations``, by batch and validity
    (``quarantined`` reads the rejected ones), ``out_path`` the scored rows by batch, ``manifest_path``
    ``(batch, n_valid, n_quarantined)``. A batch without rows, or without valid ones, has an empty result.
    """
    rules = rules or V.REQUEST_RULES
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source))
    tagged = V.row_violations(V.apply_defaults(stream, rules), rules)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch id: a replayed batch overwrites its own output
        path = f"{received_path}/batch={batch_id}"
        (batch.withColumn("valid", F.size("violations") == 0)
         .write.mode("overwrite").partitionBy("valid").parquet(path))
        received = batch.sparkSession.read.schema(T.StructType([*batch.schema.fields, T.StructField("valid", T.BooleanType())])
                                                  ).parquet(path)
        score(received.where("valid").drop("violations", "valid")).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        (received.agg(F.count_if(F.col("valid")).alias("n_valid"), F.count_if(~F.col("valid")).alias("n_quarantined"))
         .write.mode("overwrite").parquet(f"{manifest_path}/batch={batch_id}"))

    writer = tagged.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def quarantined(spark: SparkSession, received_path: str, manifest_path: str) -> DataFrame:
    """The rejected rows with their ``violations`` and ``batch``, of batches that the manifest lists."""
    done = spark.read.parquet(manifest_path).select("batch")
    return spark.read.parquet(received_path).where(~F.col("valid")).drop("valid").join(done, "batch", "left_semi")
