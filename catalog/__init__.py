"""Runnable queries: every operator bound to the given tables, with its SQL.

Each module registers queries with ``@query``.  The SQL text is an independent
statement of the result over the same tables; it is left out where SQL cannot
express the operator.
"""

from __future__ import annotations

import importlib
import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # callbacks travel with their tasks

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_SCHEMAS: dict[str, T.StructType] = {}
_MODULES = (
    "source_queries",
    "schema_queries",
    "filter_queries",
    "join_queries",
    "aggregate_queries",
    "sampling_queries",
    "function_queries",
    "incremental_queries",
    "vector_queries",
    "model_queries",
    "job_queries",
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL where there is one."""

    def keep(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its footer is read for the schema only once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries and their SQL."""
    for module in _MODULES:
        importlib.import_module(f"catalog.{module}")
    return dict(_QUERIES), dict(_SQL)
