"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle_queries as OQ
from .plans import mart_queries  # noqa: F401 - registers its queries
from .plans import queries as Q

QueryFn = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, QueryFn]:
    return dict(Q.REGISTRY)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in OQ.oracle_sql().items() if k in Q.REGISTRY}
