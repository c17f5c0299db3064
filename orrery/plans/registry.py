"""Registry of named queries and their oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame``.  Its oracle is an
ANSI SQL string over the same tables (DuckDB dialect-compatible), or absent
when the operator is not expressible in SQL (iterative fits, sampling).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its queries register."""
    from orrery.plans import (  # noqa: F401
        q_relational,
        q_vectors,
        q_text,
        q_html,
        q_json,
        q_features,
        q_metrics,
        q_models,
        q_cluster,
        q_sources,
    )
