"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.operators.checkpoints import scratch_path as scratch  # noqa: F401
from geoloom.plans.fixtures import oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, fixtures: str | None = None, sql: str | None = None):
    """Register a query; ``fixtures`` and ``sql`` form its oracle."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(fixtures or "", sql)
        return fn
    return add


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})
