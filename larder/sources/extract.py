"""Query extracts and landing.

A reader already distributes the rows, so landing is one distributed write; the
first-batch / later-batch bookkeeping of a driver loop has no counterpart here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date, datetime
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources import keyed, schemas, snapshots


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options for a JDBC read.

    With a partition column the table is read over ``partitions`` connections.
    ``bounds`` only places the strides: rows outside of them are read as well.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned JDBC read needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession, options: Mapping[str, str], schema: T.StructType | None = None
) -> DataFrame:
    """Read a JDBC table or ``(query) alias``; cast to the declared schema.

    The cast runs after the read because a JDBC reader refuses a schema that
    differs from the table's.  Decimals become doubles either way.
    """
    df = spark.read.format("jdbc").options(**options).load()
    df = schemas.decimals_to_double(df)
    return schemas.cast_to(df, schema) if schema is not None else df


def run_query(
    spark: SparkSession,
    query: str,
    tables: Mapping[str, DataFrame],
    parameters: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run a query over the given tables with bound parameters.

    ``:name`` markers take values, ``{name}`` markers take the tables.  Values
    are bound by Spark and never pasted into the text.
    """
    return spark.sql(query, args=dict(parameters or {}), **dict(tables))


def window_parameters(run_time: datetime, delta_seconds: int) -> dict[str, Any]:
    """Parameters of a change window ``[run_time - delta, run_time)``."""
    return {"run_datetime": run_time, "delta_seconds": delta_seconds}


def date_parameters(start: date | datetime, end: date | datetime) -> dict[str, Any]:
    return {"start_date": start, "end_date": end}


def extract_query(
    spark: SparkSession,
    query: str,
    tables: Mapping[str, DataFrame],
    path: str,
    parameters: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run a query, land its result as gzip JSON, and read it back."""
    return land(run_query(spark, query, tables, parameters), path)


#: Bytes of rows, as the optimiser counts them, that a writer is worth, and that one file is to hold at most.
WRITER_BYTES, FILE_BYTES = 1 << 20, 64 << 20


def _parallel(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def writers_for(df: DataFrame) -> int:
    """Writers for rows of a size: as many as run at a time, if each is worth it, and more once files would grow too large."""
    size = keyed.plan_bytes(df)
    return max(1, min(_parallel(df), -(-size // WRITER_BYTES)), -(-size // FILE_BYTES))


def land(
    df: DataFrame,
    path: str,
    callback: Callable[[DataFrame], DataFrame] | None = None,
    rows_per_file: int | None = None,
    normalise: bool = True,
    spread: int | None = None,
    json_columns: Mapping[str, T.DataType | str] | Sequence[str] = (),
    time_format: str | None = None,
) -> DataFrame:
    """Land rows as gzip JSON and return them read back with their schema.

    ``callback`` maps the DataFrame before it is written and may add fields.
    ``json_columns`` hold JSON objects as text and land nested: by the types
    given, or, for a list of names, by types that Spark merges over all rows.
    ``time_format`` is a pattern for times.  The number of writers follows the
    optimiser's estimate of the rows' bytes (``writers_for``), whatever the layout
    of the source: one connection or one large file is dealt out.  ``spread``
    sets that number, and ``rows_per_file`` cuts files further.
    """
    wanted = spread or writers_for(df)
    # few writers are dealt their rows evenly; many get partitions of a size that adaptive execution keeps even
    df = df.repartition(wanted) if spread or wanted <= _parallel(df) else df.hint("rebalance")
    rows = df.transform(callback) if callback is not None else df
    if not isinstance(json_columns, Mapping):
        json_columns = {c: schemas.infer_json_schema(rows, c) for c in json_columns}
    rows = schemas.normalize_values(rows, json_columns, time_format) if normalise else rows
    writer = rows.write.mode("overwrite").options(compression="gzip", **snapshots.JSON_TIMES)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.json(path)
    return df.sparkSession.read.options(**snapshots.JSON_TIMES).schema(rows.schema).json(path)


def batch_callback(
    fn: Callable[..., pd.DataFrame], schema: T.StructType, **arguments: Any
) -> Callable[[DataFrame], DataFrame]:
    """Turn ``fn(batch, **arguments) -> batch`` into a callback for ``land``.

    The batches are Arrow slices of a partition, so memory does not grow with it.
    """

    def over_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch, **arguments)

    return lambda df: df.mapInPandas(over_batches, schema)


def key_literal_filter(df: DataFrame, column: str, keys: DataFrame, key_column: str | None = None) -> DataFrame:
    """Rows whose ``column`` occurs in ``keys``; replaces an ``IN (...)`` text."""
    wanted = keys.select(F.col(key_column or column).alias("__key")).distinct()
    return df.join(wanted, F.col(column) == F.col("__key"), "left_semi")
