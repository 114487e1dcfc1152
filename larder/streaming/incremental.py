"""Incremental updates as micro-batches.

A micro-batch is written as one batch of changes beside the published version of
a serving table, under the stream's name and its batch id: a batch that runs again
after a failure replaces itself, and several streams may write to one table.  Its cost follows the batch.  Whatever the
order or number of batches, the folded table equals one batch recompute.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from larder.operators import merge
from larder.sources import files
from larder.sources.keyed import KeyedTable
from larder.sources.serving import ServingTable


def change_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Change rows arriving as Parquet files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def with_late_policy(stream: DataFrame, time: str, delay: str, ids: Sequence[str]) -> DataFrame:
    """Drop repeated ids that arrive within ``delay`` of each other and bound
    the state kept for that.  A time without a zone is read in the session's."""
    zoned = stream.withColumn(time, F.col(time).cast("timestamp"))
    return zoned.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(ids))


def split_late_stream(stream: DataFrame, time: str, delay_seconds: float, path: str, checkpoint: str) -> StreamingQuery:
    """Write rows that are not late below ``path/on_time`` and late ones, which a watermark would drop, below ``path/late``.

    A row is late if its time is more than the delay before the newest time of all earlier micro-batches, which lies in
    ``path/newest``, one row for each batch.  All three are written by batch, so a batch that runs again finds the same
    earlier ones and replaces its own rows.  Rows without a time are on time.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        names = [n for n in files.child_directories(spark, f"{path}/newest") if int(n.partition("=")[2]) < batch_id]
        earlier = [f"{path}/newest/{n}" for n in names]
        top = spark.read.parquet(*earlier).agg(F.max("newest")).first()[0] if earlier else None
        rows = batch.persist()
        span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(delay_seconds)))
        late = F.coalesce(F.col(time) < F.lit(top) - span, F.lit(False)) if top is not None else F.lit(False)
        for name, wanted in (("on_time", ~late), ("late", late)):
            rows.filter(wanted).write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        rows.agg(F.max(time).alias("newest")).write.mode("overwrite").parquet(f"{path}/newest/batch={batch_id}")
        rows.unpersist()

    return _start(stream, each, checkpoint)


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """All rows that ``split_late_stream`` wrote, with ``batch`` and whether they came ``late``."""
    sides = [spark.read.parquet(f"{path}/{name}").withColumn("late", F.lit(name == "late")) for name in ("on_time", "late")]
    return sides[0].unionByName(sides[1])


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def writer_of(checkpoint: str) -> str:
    """A stream's name as a writer: the same whenever it starts again from its checkpoint."""
    return f"stream-{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:16]}"


def upsert_stream(
    stream: DataFrame,
    table: ServingTable,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Upsert change rows into a serving table, the newest one per id winning.

    The table's ``order`` decides inside a micro-batch and over micro-batches,
    so changes may arrive late or in any order.
    """
    if not table.order:
        raise ValueError("an upsert stream needs a table with an order")

    def each(batch: DataFrame, batch_id: int) -> None:
        last = merge.latest_change(transform(batch), table.ids, table.order)
        table.write(last, "incremental", batch=batch_id, writer=writer_of(checkpoint))

    return _start(stream, each, checkpoint)


def reload_stream(
    stream: DataFrame,
    documents: KeyedTable | Callable[[], DataFrame],
    table: ServingTable,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Detect, reload, transform, upsert.

    Change rows only name ids; their full documents are read from the source, transformed, and replace what the table
    holds.  A keyed source is read in the directories of the changed ids alone; any other is scanned in every micro-batch.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        keys = batch.select(*table.ids).distinct()
        keyed = isinstance(documents, KeyedTable)
        reloaded = documents.load(keys) if keyed else documents().join(keys, list(table.ids), "left_semi")
        table.write(transform(reloaded), "incremental", batch=batch_id, writer=writer_of(checkpoint))

    return _start(stream, each, checkpoint)


def aggregate_stream(
    stream: DataFrame, path: str, ids: Sequence[str], aggregates: Mapping[str, Column], checkpoint: str
) -> StreamingQuery:
    """Write each micro-batch as one row of partial aggregates per id."""

    def each(batch: DataFrame, batch_id: int) -> None:
        partial = batch.groupBy(*ids).agg(*[c.alias(n) for n, c in aggregates.items()])
        partial.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _start(stream, each, checkpoint)


def fold_aggregates(spark: SparkSession, path: str, ids: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """All partial aggregates folded by their rules, batches in order."""
    complete = [n for n in files.child_directories(spark, path) if files.exists(spark, f"{path}/{n}/_SUCCESS")]
    partial = spark.read.option("basePath", path).parquet(*[f"{path}/{n}" for n in complete])
    return merge.pre_aggregate(partial, ids, rules, ["batch"])


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an available-now query; raises what it failed with."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
