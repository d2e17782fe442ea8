"""
result, each a (spark, sf_dir) -> DataFrame callable over the driver's tables,
with its DuckDB SQL oracle where SQL can express it.

Queries are registered in topic modules (``q_core``, ``q_scalar``, ...) with
the ``query`` decorator; importing this module loads them all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` (and its oracle SQL, if any)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> tuple[dict, dict]:
    from . import q_core, q_scalar, q_analytics, q_quality, q_versions, q_io  # noqa: F401
    return QUERIES, ORACLE
