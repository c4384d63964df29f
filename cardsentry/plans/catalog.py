"""Registered report queries: key -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the driver tables in ``sf_dir``
and returns a lazy DataFrame; nothing is collected.  Keys follow the operator
IDs of the blueprint (lower case id + name).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from . import (queries_core, queries_reports, queries_scd, queries_quality, queries_ml,  # noqa: F401
                   queries_incremental, queries_jobs, queries_streaming)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
