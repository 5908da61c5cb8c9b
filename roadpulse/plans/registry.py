"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries_features, queries_history, queries_live, queries_models, queries_roads, queries_streams

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (queries_history, queries_roads, queries_live, queries_features, queries_streams, queries_models)


def queries() -> dict[str, Query]:
    return {name: run for module in _MODULES for name, (run, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL by query name; trained models and solved regressions have none."""
    return {name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql}
