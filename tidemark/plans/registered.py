"""Collects the registered queries and their SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path
from tidemark.sources.tables import create_database

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL it is checked by rows and by the tests only."""

    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return keep


def scratch_database(spark: SparkSession) -> str:
    """A fresh database whose tables lie in the shared scratch folder."""
    name = f"scratch_{uuid.uuid4().hex[:12]}"
    create_database(spark, name, scratch_path(spark, name))
    return name


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    from tidemark.plans import queries_explore, queries_features, queries_models, queries_monitor  # noqa: F401

    return dict(QUERIES), dict(SQL)
