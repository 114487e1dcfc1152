"""Aggregations.  One pass each; Spark combines on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from larder.functions import numbers, text


def first_seen(df: DataFrame, keys: Sequence[str], time: str, out: str = "logged_at") -> DataFrame:
    """Earliest time per key; ``min`` rather than an order-dependent ``first``."""
    return df.groupBy(*keys).agg(F.min(time).alias(out))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str] | None = None) -> DataFrame:
    """The row with the largest order values per key.

    ``max_by`` keeps one row per key and map task, so a hot key is reduced
    before the shuffle.  End ``order`` with a unique column to fix ties.
    """
    kept = list(fields) if fields is not None else [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*kept), F.struct(*order)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in kept])


def one_row_per_key(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One deterministic row per key: the one with the largest field values."""
    best = F.max(F.struct(*fields)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in fields])


# Fixed value: the smallest score that counts as positive feedback.
POSITIVE_SCORE = 3.0


def positive_ratio(df: DataFrame, key: str, interaction: str) -> DataFrame:
    """Positive and negative counts and the share of positives per key.

    The score may be text; text that is not a number counts on neither side.
    """
    score = numbers.to_number(interaction)
    sums = df.groupBy(key).agg(
        F.count_if(score >= POSITIVE_SCORE).alias("positive_sum"),
        F.count_if(score < POSITIVE_SCORE).alias("negative_sum"),
    )
    whole = F.col("positive_sum") + F.col("negative_sum")
    return sums.withColumn("positive_ratio", numbers.ratio(F.col("positive_sum"), whole))


def positive_negative_sums(df: DataFrame, key: str, interaction: str) -> DataFrame:
    """The two sums side by side, without joining two aggregations."""
    return positive_ratio(df, key, interaction).drop("positive_ratio")


def global_mean(df: DataFrame, field: str, out: str = "mean") -> DataFrame:
    return df.agg(F.avg(field).alias(out))


def sorted_tag_text(df: DataFrame, key: str | Sequence[str], tag: str, out: str = "tag_names") -> DataFrame:
    """All tags of a key, sorted and joined by a space; repeated tags repeat.

    Tags are counted first, so what is shuffled and gathered per key is its
    distinct tags, bounded by the vocabulary, not its rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counted = df.groupBy(*keys, tag).agg(F.count("*").cast("int").alias("__n"))
    pair = F.when(F.col(tag).isNotNull(), F.struct(F.col(tag).alias("tag"), F.col("__n").alias("n")))
    gathered = counted.groupBy(*keys).agg(F.array_sort(F.collect_list(pair)).alias("__tags"))
    repeated = F.flatten(F.transform("__tags", lambda t: F.array_repeat(t["tag"], t["n"])))
    return gathered.select(*keys, F.array_join(repeated, " ").alias(out))


def sorted_tag_chunks(df: DataFrame, key: str | Sequence[str], tag: str, per_chunk: int, out: str = "tag_names") -> DataFrame:
    """(key, chunk, text): the sorted tags of a key in rows of ``per_chunk`` tags, so that no cell grows with a key's rows.

    Chunks are numbered from 0; their texts, one after the other, are that of ``sorted_tag_text``.  Keys without a tag
    have no row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counted = df.filter(F.col(tag).isNotNull()).groupBy(*keys, tag).agg(F.count("*").alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy(*keys).orderBy(tag))
    placed = counted.withColumn("__end", upto).withColumn("__start", F.col("__end") - F.col("__n"))
    chunk = F.sequence(F.floor(F.col("__start") / per_chunk), F.floor((F.col("__end") - 1) / per_chunk))
    cut = placed.withColumn("chunk", F.explode(chunk))
    copies = F.least("__end", (F.col("chunk") + 1) * per_chunk) - F.greatest("__start", F.col("chunk") * per_chunk)
    gathered = cut.groupBy(*keys, "chunk").agg(F.array_sort(F.collect_list(F.struct(F.col(tag).alias("tag"), copies.cast("int").alias("n")))).alias("__t"))
    repeated = F.flatten(F.transform("__t", lambda t: F.array_repeat(t["tag"], t["n"])))
    return gathered.select(*keys, "chunk", F.array_join(repeated, " ").alias(out))


def max_condensed_length(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(F.length(text.condense(column))).alias("max_length"))


def distinct_categories(df: DataFrame, badges: str, out: str = "badge") -> DataFrame:
    """Distinct non-empty parts of pipe-joined texts."""
    parts = df.select(F.explode(text.split_badges(badges)).alias(out))
    return parts.filter(F.col(out) != "").distinct()


def category_counts(df: DataFrame, category: str) -> DataFrame:
    """(category, n, mean_n): rows per category and the mean over categories."""
    counts = df.groupBy(category).agg(F.count("*").alias("n"))
    return counts.withColumn("mean_n", counts.agg(F.avg("n")).scalar())


def confusion(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """True/false positive and false negative counts, optionally per group."""
    actual, predicted = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*keys).agg(
        F.count_if(actual & predicted).alias("true_positive"),
        F.count_if(~actual & predicted).alias("false_positive"),
        F.count_if(actual & ~predicted).alias("false_negative"),
        F.count_if(predicted).alias("predicted_positive"),
        F.count("*").alias("n"),
    )


def classification_metrics(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 in one pass; undefined values are null."""
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    return (
        confusion(df, label, prediction, keys)
        .withColumn("precision", numbers.ratio(tp, tp + fp))
        .withColumn("recall", numbers.ratio(tp, tp + fn))
        .withColumn("f1", numbers.f1(F.col("precision"), F.col("recall")))
    )


def vector_mean(df: DataFrame, keys: Sequence[str], vector: str, out: str = "vector") -> DataFrame:
    """Element-wise mean vector per key.

    One running sum per key and map task is shuffled, not one row per element.
    """
    rows = df.filter(F.col(vector).isNotNull()).withColumn("__v", array_to_vector(F.col(vector).cast("array<double>")))
    means = rows.groupBy(*keys).agg(Summarizer.mean(F.col("__v")).alias("__mean"))
    return means.select(*keys, vector_to_array("__mean").alias(out))


def observe_count(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count the rows passing this point while the plan runs, without a job."""
    watch = Observation(stage)
    return df.observe(watch, F.count("*").alias("rows")), watch


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) for several stages of a plan."""
    counted = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows") for name, df in stages.items()
    ]
    result = counted[0]
    for more in counted[1:]:
        result = result.unionByName(more)
    return result


def changed_count(df: DataFrame, key: str, changed: Column) -> DataFrame:
    """One row: the number of distinct keys among the changed rows."""
    return df.filter(changed).agg(F.count_distinct(key).alias("changed"))
