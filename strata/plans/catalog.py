"""Registry of named queries: a Spark callable and, where the result can be
written in SQL, the DuckDB oracle text that must return the same rows.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame built by the
library operators over the driver tables (or fixture views derived from
them by Spark).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from strata.plans import (  # noqa: F401
        q_contracts, q_evaluate, q_explain, q_features, q_profile, q_sources, q_splits, q_stats,
        q_stream, q_train,
    )
