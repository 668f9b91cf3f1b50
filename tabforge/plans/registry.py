"""Registry of named queries (Spark) and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads the driver tables
(or views Spark derives from them) in full and returns full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir)`` under ``name`` (and its oracle)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module so its registrations run."""
    from tabforge.plans import (q_prep, q_metrics, q_profile, q_synth, q_select,  # noqa: F401
                                q_model, q_facts)


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
