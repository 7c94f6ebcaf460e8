"""The query catalogue behind ``__spark_entry__.queries()`` / ``oracle_sql()``.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` over the fixture views and, where SQL can
express the operator, an independent DuckDB query over the same driver tables. Computed doubles are
rounded to 6 decimals on both sides; pass-through columns are not touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Pinned "current year" for reproducible checks: fixture years run 1995-2020, so the year filter
# and Car_Age = 0 are both exercised.
AS_OF_YEAR = 2015


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def load_all() -> None:
    # Importing the modules fills the registry.
    from autoprice.plans import (q_clean, q_profile, q_split, q_features, q_metrics,  # noqa: F401
                                 q_abtest, q_registry, q_monitor, q_io, q_stream, q_models)
