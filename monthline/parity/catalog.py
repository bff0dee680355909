"""Registry of queries: name -> (Spark query, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

SPARK: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        if name in SPARK:
            raise ValueError(f"query {name} is registered twice")
        SPARK[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    from monthline.parity import (  # noqa: F401
        aggregates,
        feature_queries,
        files,
        forecasts,
        model_queries,
        monitors,
        quality,
        scalars,
    )

    return dict(SPARK), dict(SQL)
