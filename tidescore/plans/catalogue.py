"""The registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `check` is the same question in plain SQL over the same tables."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return add


def load() -> None:
    """Import every module that registers queries."""
    from tidescore.plans import (  # noqa: F401
        feature_queries,
        model_queries,
        registry_queries,
        resolve_queries,
        stream_queries,
        training_queries,
    )
