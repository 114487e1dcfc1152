"""Set operations, sampling, splitting, class inflation.

Sampling is a function of the row key: stable over runs, retries, partitionings
and engines.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from larder import session
from larder.functions import hashing

#: The most rows of the last hash range of an exact sample, which are ranked in one place.
EDGE_ROWS = 100_000
#: Size of the quantile sketch of an exact sample, and the share of rows on either side of its answer that the quota may
#: lie in: three times the sketch's error.
SKETCH, BRACKET = 4096, 0.003


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def subtract(left: DataFrame, right: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Rows of ``left`` not in ``right``, matched by column name.

    The default removes duplicates as well; with ``keep_duplicates`` each row of
    ``right`` removes one copy.
    """
    right = right.select(*left.columns)
    return left.exceptAll(right) if keep_duplicates else left.subtract(right)


def in_sample(keys: Sequence[str], fraction: float, seed: int = 42) -> Column:
    """True for about ``fraction`` of all keys: those whose hash is below that share of the span, however small it is."""
    return hashing.key_hash(*keys, seed=seed) < F.lit(int(fraction * hashing.HASH_SPAN)).cast("bigint")


def sample_by_key(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows, chosen by a hash of their key."""
    return df.filter(in_sample(keys, fraction, seed))


def sample_exact(df: DataFrame, keys: Sequence[str], factor: float, seed: int = 42, edge_rows: int = EDGE_ROWS) -> DataFrame:
    """Exactly ``int(factor * n)`` rows, keys being unique: those with the smallest key hashes.

    One scan counts the keys and sketches the quantiles of their hashes, partly in each task.  A second one writes the keys
    between the hashes where the quota must end, about one in a hundred, and counts those below.  Ranks are found in that
    small table: histograms of 4,096 hash ranges narrow it to at most ``edge_rows`` rows, which are ranked.  Should the sketch
    have missed, all keys take the place of the table.  The rows themselves are kept or not by one comparison.
    """
    places = df.select(hashing.key_hash(*keys, seed=seed).alias("__h"), *keys)
    ranks = [max(0.0, factor - BRACKET), min(1.0, factor + BRACKET)]
    ends = F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint("__h", F.lit(SKETCH)), F.array(*map(F.lit, ranks)))
    total, found = places.agg(F.count("*"), F.when(F.count("*") > 0, ends)).first()
    quota = math.floor(factor * total)
    if not quota:
        return df.filter(F.lit(False))
    low = found[0] if ranks[0] > 0 else 0
    high = found[1] + 1 if ranks[1] < 1 else hashing.HASH_SPAN
    sides = Observation()
    watched = places.observe(sides, F.count_if(F.col("__h") < low).alias("below"), F.count_if(F.col("__h") < high).alias("upto"))
    inside = session.materialise(watched.filter((F.col("__h") >= low) & (F.col("__h") < high)), "sample-edge")
    below, upto = sides.get["below"], sides.get["upto"]
    if below < quota <= upto:
        places, width, left = inside, high - low, quota - below
    else:
        low, width, left = 0, hashing.HASH_SPAN, quota
    while True:
        width = max(1, width // 4096)
        part = F.floor((F.col("__h") - low) / width).cast("bigint")
        sizes = places.withColumn("__r", part).groupBy("__r").agg(F.count("*").alias("__n"))
        # at most 8,192 rows are accumulated in one place
        upto = sizes.withColumn("__upto", F.sum("__n").over(Window.orderBy("__r")))
        edge = upto.filter(F.col("__upto") >= left).orderBy("__r").first()
        low, left = low + edge["__r"] * width, left - (edge["__upto"] - edge["__n"])
        places = places.filter((F.col("__h") >= low) & (F.col("__h") < low + width))
        if edge["__n"] <= edge_rows or width == 1:
            break
    place = F.struct("__h", *keys)
    last_place = places.orderBy("__h", *keys).limit(left).agg(F.max(place)).scalar()
    rows = df.withColumn("__h", hashing.key_hash(*keys, seed=seed))
    on_edge = (F.col("__h") < low + width) & F.coalesce(place <= last_place, F.lit(False))
    return rows.filter((F.col("__h") < low) | on_edge).drop("__h")


def split_phases(
    df: DataFrame,
    keys: Sequence[str],
    test: float = 0.1,
    dev: float = 0.09,
    seed: int = 42,
    out: str = "phase",
) -> DataFrame:
    """Assign each row to test, validation or train in one pass.

    ``test`` of the rows, then ``dev`` of the rest, then the remainder.  Copies
    of a key share a phase, so the phases are disjoint and complete.
    """
    phase = F.when(in_sample(keys, test, seed), "test").when(in_sample(keys, dev, seed + 1), "validation")
    return df.withColumn(out, phase.otherwise("train"))


def inflation_rates(df: DataFrame, category: str, categories: Sequence[Any]) -> DataFrame:
    """(category, n, rate): ``floor(0.5 * mean / n) + 1`` copies per category.

    The mean is the count of all rows over the number of listed categories.
    Only listed categories pass, so there are at most that many rows.
    """
    counts = df.groupBy(category).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("n")).scalar()
    rate = F.floor(0.5 * (total / F.lit(len(categories))) / F.col("n")) + 1
    return counts.filter(F.col(category).isin(list(categories))).withColumn("rate", rate.cast("int"))


def inflate_classes(df: DataFrame, category: str, categories: Sequence[Any]) -> DataFrame:
    """Repeat the rows of small categories; rows of unlisted ones are dropped.

    The rates have one row per listed category, hence the broadcast; the rows
    themselves are not shuffled.
    """
    rates = F.broadcast(inflation_rates(df, category, categories).select(category, "rate"))
    copies = df.join(rates, category, "inner")
    return copies.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rate")))).drop("rate")


def write_phases(df: DataFrame, path: str, phase: str = "phase") -> None:
    """One directory per phase, written in a single pass."""
    df.write.mode("overwrite").partitionBy(phase).parquet(path)


def phase_counts(df: DataFrame, phase: str = "phase", extra: Mapping[str, str] | None = None) -> DataFrame:
    """Rows per phase, with optional ``{out: distinct column}`` counts."""
    more = [F.count_distinct(c).alias(n) for n, c in (extra or {}).items()]
    return df.groupBy(phase).agg(F.count("*").alias("n"), *more)
