"""Operators of a training-data pipeline: clean, deduplicate, tokenize, score, pack and shard text.

Nothing else in the library imports this subpackage.  Each module holds one operator with a general interface,
its query ``opN_<name>`` over ``documents``, and the query's SQL where SQL can state it.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = (
    "packing",
    "pieces",
    "sketches",
    "toxicity",
    "language_model",
    "quality",
    "secrets",
    "token_files",
    "simhash",
    "sharding",
    "negatives",
    "alignment",
    "substrings",
)


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of all operators."""
    queries, sql = {}, {}
    for name in MODULES:
        module = importlib.import_module(f"larder.llm.{name}")
        queries |= module.QUERIES
        sql |= getattr(module, "SQL", {})
    return queries, sql
