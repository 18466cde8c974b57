"""Registry of named queries: name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL).

Every query reads the driver tables (through the fixture views) over their
whole extent; none uses a made-up input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from pricelens.plans import (  # noqa: F401
        cases_clean, cases_insights, cases_io, cases_match, cases_parse, cases_star, cases_summary, cases_verdicts,
    )
