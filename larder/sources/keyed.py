"""Tables laid out by key: one directory for each hash of the key, so that a set of keys reads only its own directories.

A look-up joins on the directory column as well as on the key.  Where the keys are few enough to be broadcast, which
Spark decides by their written size, it prunes the directories at run time; where they are not, they touch most
directories anyway and the join is an ordinary one.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import session
from larder.sources import files

#: The directory column.
BUCKET = "key_bucket"
_DESCRIPTION = "_description"


def plan_bytes(df: DataFrame) -> int:
    """The optimiser's estimate of the bytes that a query returns."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def buckets_for(df: DataFrame, bytes_each: int = 128 << 20, least: int = 16, most: int = 1 << 16) -> int:
    """A power of two, so that a directory holds about ``bytes_each``."""
    wanted = -(-plan_bytes(df) // bytes_each)
    return max(least, min(most, 1 << max(0, wanted - 1).bit_length()))


def bucket_of(ids: Sequence[str], buckets: int) -> Column:
    """The directory of a key; whole numbers of any width and the same text are one key."""
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in ids]), F.lit(buckets)).cast("int")


def write(df: DataFrame, path: str, ids: Sequence[str], buckets: int) -> None:
    """Write by directory; AQE splits large directories over tasks and joins small ones."""
    placed = df.withColumn(BUCKET, bucket_of(ids, buckets)).hint("rebalance", F.col(BUCKET))
    placed.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def with_bucket(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])


def keys_of(df: DataFrame, ids: Sequence[str], buckets: int) -> DataFrame:
    """The distinct keys of ``df`` and their directories, written so that their size is known when a join is planned."""
    keys = session.materialise(df.select(*ids).dropna().distinct().withColumn(BUCKET, bucket_of(ids, buckets)), "keys")
    # says no more than the hash does, but makes the keys count as selective, without which Spark does not prune
    return keys.filter(F.col(BUCKET) >= 0)


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path`` by the hash of ``ids``, which other frames may call by the same names."""

    spark: SparkSession
    path: str
    ids: Sequence[str]

    def write(self, df: DataFrame, buckets: int | None = None) -> KeyedTable:
        number = buckets or buckets_for(df)
        write(df, self.path, self.ids, number)
        files.write_text(self.spark, f"{self.path}/{_DESCRIPTION}", json.dumps({"buckets": number, "schema": df.schema.jsonValue()}))
        return self

    def _described(self) -> tuple[int, DataFrame]:
        text = files.read_text(self.spark, f"{self.path}/{_DESCRIPTION}")
        if text is None:
            raise FileNotFoundError(f"no keyed table at {self.path}")
        known = json.loads(text)
        schema = with_bucket(T.StructType.fromJson(known["schema"]))
        return known["buckets"], self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._described()[1].drop(BUCKET)

    def load(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys.  Repeated keys do not repeat rows; null keys have none."""
        buckets, rows = self._described()
        return rows.join(keys_of(keys, self.ids, buckets), [BUCKET, *self.ids], "left_semi").drop(BUCKET)
