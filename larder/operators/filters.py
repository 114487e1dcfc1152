"""Filters and predicates.  All of them reach the scan where the source allows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import text


def where(df: DataFrame, condition: str) -> DataFrame:
    """Rows that satisfy a configured SQL predicate."""
    return df.filter(condition)


def between_half_open(df: DataFrame, column: str, start: Any, end: Any) -> DataFrame:
    """``start <= column < end``.

    The bounds are cast to the column's type, never the column to theirs, so
    the comparison is pushed to the Parquet footer statistics.
    """
    kind = df.schema[column].dataType
    return df.filter((F.col(column) >= F.lit(start).cast(kind)) & (F.col(column) < F.lit(end).cast(kind)))


def drop_null_ids(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    return df.dropna("any", subset=list(ids))


def rename_keys(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def passed(df: DataFrame, request: str = "req", response: str = "res") -> DataFrame:
    """Requested items without a response."""
    return df.filter((F.col(request) == 1) & F.col(response).isNull())


def matched(df: DataFrame, response: str = "res") -> DataFrame:
    """Items with a response, requested or not."""
    return df.filter(F.col(response) == 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, null_count) for every column in one pass; NaN counts as null."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}

    def missing(c: str):
        empty = F.col(c).isNull()
        return empty | F.isnan(c) if c in floating else empty

    totals = df.agg(*[F.count_if(missing(c)).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in columns])
    return totals.select(F.explode(pairs).alias("p")).select("p.column", "p.null_count")


def assert_no_nulls(df: DataFrame, columns: Sequence[str]) -> None:
    """Fail with the names of the feature columns that hold nulls or NaN."""
    bad = [r["column"] for r in null_counts(df, columns).filter("null_count > 0").take(len(columns))]
    if bad:
        raise ValueError(f"null values in feature columns: {', '.join(bad)}")


def with_positive_length(df: DataFrame, column: str, out: str = "text_length") -> DataFrame:
    """Add the text length and keep rows where it is positive."""
    return df.withColumn(out, text.text_length(column)).filter(F.col(out) > 0)


def with_exact_length(df: DataFrame, column: str, length: int) -> DataFrame:
    """Rows whose text has exactly ``length`` characters, white space aside."""
    return df.filter(F.length(text.condense(column)) == length)


def write_category_slices(
    df: DataFrame, path: str, category: str, wanted: Sequence[Any] | None = None, mode: str = "overwrite"
) -> None:
    """Write one sub-directory per category in a single pass.

    Readers that filter on the category read only its directory.  Rows are
    rebalanced by category first: a small category is one file, a large one is
    split over many tasks by its size.
    """
    rows = df if wanted is None else df.filter(F.col(category).isin(list(wanted)))
    rows.hint("rebalance", F.col(category)).write.mode(mode).partitionBy(category).parquet(path)
