"""The operators as named queries over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    bpe, lm, packing, periodic, phrases, pii, quality, rollups, rules, secrets, sharding, simhash, vectors)
from strata.llm.common import table, written
from strata.session import shared_dir

BPE_JSON, BPE_RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SURROGATE_KEY = b"surrogate-key-1"  # a deployment passes its own


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary(BPE_JSON))


def op4_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary(BPE_RANKS), public_tokenizers.PATTERN)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(table(spark, sf_dir, "documents"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all documents, reached by a history in which every batch changes them for good.

    A tenth is loaded uncounted and revised later, a tenth comes in only after the snapshot, a tenth is
    loaded a second time under another source and deleted there; a batch is replayed after the snapshot.
    """
    rows = written(rollups.counted(table(spark, sf_dir, "documents"), {"byte_bpe_50k": vocabulary(BPE_JSON)}), "counted")
    store = rollups.Rollup(spark, shared_dir(spark, f"llm/rollup-{uuid.uuid4().hex}"))
    tenth = F.pmod(F.xxhash64("doc_id"), F.lit(10))
    stale = rows.withColumn("n_tokens", F.when(tenth == 0, 0).otherwise(F.col("n_tokens")))
    mirror = rows.filter(tenth == 2).withColumn("source", F.lit("mirror"))
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))
    for own in (0, 1):
        store.commit(f"load-{own}", rollups.signed(stale.filter((half == own) & (tenth != 1)), 1))
    store.commit("mirror-0", rollups.signed(mirror, 1))
    store.fold()
    store.commit("load-1", rollups.signed(stale.filter((half == 1) & (tenth != 1)), 1))  # a replay, adds nothing
    store.commit("insert-0", rollups.signed(rows.filter(tenth == 1), 1))
    store.commit("delete-0", rollups.signed(mirror, -1))
    store.commit("revise-0", rollups.revised(stale.filter(tenth == 0), rows.filter(tenth == 0)))
    return store.totals()


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.detect(table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pii_surrogates, op2_quality_rules, op3_best_fit_packing, op4_bpe_transducer, op5_simhash_near_dedup,
        op6_secret_scan, op7_embedding_near_dedup, op8_token_rollups, op9_lm_scoring, op10_quality_classifier,
        op11_phrase_collocations, op12_periodic_runs, op13_sharding)}

ORACLE: dict[str, str] = {"op2_quality_rules": rules.ORACLE, "op7_embedding_near_dedup": vectors.ORACLE,
                          "op11_phrase_collocations": phrases.ORACLE}
