"""Top-k, sorting and sequential ids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import hashing


def top_k(df: DataFrame, score: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k best rows; each task keeps k, so nothing is sorted in full."""
    return df.orderBy(F.col(score).desc_nulls_last(), *tie).limit(k)


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def next_id(df: DataFrame, column: str, out: str = "next_id") -> DataFrame:
    """Largest id + 1, or 1 for an empty table."""
    return df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("bigint").alias(out))


def dense_ids(
    df: DataFrame, key: str, category: Sequence[str] = (), out: str = "vid", rows_per_group: int = 500_000, seed: int = 42
) -> DataFrame:
    """Ids 0, 1, 2, … per category, in the order of (key hash, key): the same on every run.

    Rows are numbered inside ranges of the hash and shifted by the number of rows in earlier ranges, so a category of any
    size is numbered by many tasks.  There are as many ranges as keep each at about ``rows_per_group`` rows, however many
    rows there are; the ids do not depend on that.  Keys must be unique per category.
    """
    groups = [*category, "__bucket"]
    width = hashing.HASH_SPAN // max(1, -(-df.count() // rows_per_group)) + 1
    placed = df.withColumn("__hash", hashing.key_hash(key, seed=seed)).withColumn("__bucket", F.floor(F.col("__hash") / width).cast("int"))
    earlier = Window.partitionBy(*category).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*groups).agg(F.count("*").alias("__size"))
    shift = F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__shift")
    other = {g: f"__of_{g}" for g in groups}
    shifts = sizes.select(*[F.col(g).alias(o) for g, o in other.items()], shift)
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(o)) for g, o in other.items()])
    inside = F.row_number().over(Window.partitionBy(*groups).orderBy("__hash", key)).cast("bigint") - 1
    numbered = placed.withColumn("__inside", inside).join(shifts, same)
    numbered = numbered.withColumn(out, F.col("__inside") + F.col("__shift"))
    return numbered.drop("__bucket", "__hash", "__inside", "__shift", *other.values())


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """The first k rows of each group.  Spark cuts each task's share of a group
    to k rows before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(out, rank).filter(F.col(out) <= k)
