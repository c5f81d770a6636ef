"""Name -> (query, SQL). Queries take (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

GROUPS = ("scans", "projections", "joins", "aggregates", "windows", "ranking", "scalars",
          "forecasts", "streams")


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    for group in GROUPS:
        import_module(f"tickloom.plans.{group}")
