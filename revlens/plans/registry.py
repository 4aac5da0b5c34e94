"""Registry of named queries.

A query is ``fn(spark, sf_dir) -> DataFrame``.  ``sql`` is the DuckDB oracle
over the driver tables (None for rows-only checks: ML, streaming).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    key: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    survey_ids: tuple[str, ...]
    bench: bool


QUERIES: dict[str, Query] = {}


def register(key: str, sql: str | None = None, ids: tuple[str, ...] = (), bench: bool = True):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = Query(key, fn, sql, tuple(ids), bench)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # importing the plan modules registers their queries
    from revlens.plans import dashboard, evaluation, live, ml_plans, prep, profiling, streams, text  # noqa: F401

    return QUERIES
