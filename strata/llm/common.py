"""Helpers shared by the operators: table access, written intermediates, Arrow loops, stable splits."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_dir

_WRITTEN: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage with a copy that every executor can reread after one is
    lost. ``release`` removes the copies of finished work.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete every intermediate table written so far; call it when no result is read any more."""
    n = 0
    while _WRITTEN:
        p = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return n


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` on every Arrow batch, one after the other; nothing is kept between batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield fn(b)

    return df.mapInArrow(run, schema)


def raw_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [b"" if t is None else t for t in col.to_pylist()]


def id_share(col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)
