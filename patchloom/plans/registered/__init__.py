"""Registered queries: each runs an operator over the given tables.

A query is a function of (spark, folder of parquet tables). Where SQL can say
the same thing, the text stands next to it and is the reference for its result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    from patchloom.sources.tables import scan_path

    return scan_path(spark, f"{folder}/{name}.parquet", columns)


def load_all() -> None:
    """Import the modules that register queries."""
    from patchloom.plans.registered import features, images, lookups, metrics, models, scans  # noqa: F401
