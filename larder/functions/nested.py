"""JSON text and nested columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def looks_like_json_object(c: Column | str) -> Column:
    """True where the trimmed text is an object with at least one quoted name."""
    text = F.trim(_column(c))
    return text.startswith("{") & text.endswith("}") & (F.instr(text, '"') > 1)


def parse_json(c: Column | str, schema: T.DataType | str) -> Column:
    """JSON text to a nested value; text that does not parse becomes null."""
    return F.from_json(_column(c), schema)


def parse_json_array(c: Column | str, schema: T.DataType | str) -> Column:
    """An array of JSON texts to an array of nested values."""
    return F.transform(_column(c), lambda x: F.from_json(x, schema))


def json_or_raw(df: DataFrame, field: str) -> DataFrame:
    """Add ``<field>_json``, a Variant holding the parsed value.

    The Variant is null where the text is not JSON; the text stays in
    ``field``, so nothing is lost for rows that do not parse.
    """
    return df.withColumn(f"{field}_json", F.try_parse_json(F.col(field)))


def to_json_text(c: Column | str, keep_nulls: bool = False) -> Column:
    """Nested value to JSON text, without null fields unless asked."""
    return F.to_json(_column(c), {"ignoreNullFields": str(not keep_nulls).lower()})


def merge_to_array(df: DataFrame, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """Gather columns into one list column each and drop the sources."""
    added = {name: F.array(*[F.col(c) for c in cols]) for name, cols in mapping.items()}
    return _replace(df, mapping, added)


def merge_to_struct(df: DataFrame, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """Gather columns into one nested object each and drop the sources."""
    added = {name: F.struct(*[F.col(c) for c in cols]) for name, cols in mapping.items()}
    return _replace(df, mapping, added)


def _replace(df: DataFrame, mapping: Mapping[str, Sequence[str]], added: Mapping[str, Column]) -> DataFrame:
    gone = {c for cols in mapping.values() for c in cols} - set(added)
    kept = [F.col(c) for c in df.columns if c not in gone and c not in added]
    return df.select(*kept, *[c.alias(n) for n, c in added.items()])
