"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the sorted array of the k smallest hashes of a text's distinct five-word shingles.  Sketches of parts
merge into the sketch of the whole, and two sketches estimate resemblance, containment and distinct shingles.  Up to
k distinct shingles every estimate is exact; beyond, the standard error of a resemblance of 1/2 is 0.5 / sqrt(k).

A text of fewer than five words has one shingle, its whole sequence of words; a null, empty or blank text has an
empty sketch.  Two empty sketches are alike (1), an empty and another one are not (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import bind, documents, fit_rows, words_of

K = 128
SHINGLE = 5


def sketch(text: Column, k: int = K) -> Column:
    """The bottom-k sketch of a text, an array of long."""

    def of_hashes(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - SHINGLE)
        shingles = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + n) for n in range(SHINGLE)]))
        few = F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(h)))
        return F.when(F.size(h) < SHINGLE, few).otherwise(F.slice(F.sort_array(F.array_distinct(shingles)), 1, k))

    return bind(F.transform(words_of(text), lambda w: F.xxhash64(w)), of_hashes)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, group: list[str], column: str, k: int = K) -> DataFrame:
    """(group, column): the merged sketch of each group.

    Hashes are made distinct and cut to k in each partition before they are moved, so a group of any size sends at
    most k hashes from a partition to the task that ends it.
    """
    hashes = df.select(*group, F.explode(column).alias("__h")).distinct()
    place = F.row_number().over(Window.partitionBy(*group).orderBy("__h"))
    lowest = hashes.withColumn("__place", place).filter(F.col("__place") <= k)
    return lowest.groupBy(*group).agg(F.sort_array(F.collect_list("__h")).alias(column))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    place = (F.get(a, F.lit(k - 1)).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / place)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of either that both have."""

    def of_union(union: Column) -> Column:
        shared = F.size(F.array_intersect(F.array_intersect(union, a), b))
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))

    return bind(merge(a, b, k), of_union)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has."""

    def of_likeness(likeness: Column) -> Column:
        shared = likeness / (1 + likeness) * (distinct_shingles(a, k) + distinct_shingles(b, k))
        return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))

    return bind(resemblance(a, b, k), of_likeness)


def as_text(a: Column) -> Column:
    """A sketch as 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


#: At most so many blocks, hence at most so many block edges, which may be broadcast.
MOST_BLOCKS = 1 << 16


def with_next(df: DataFrame, key: str, columns: list[str], more: dict[str, Column] | None = None, rows_per_block: int = 4096) -> DataFrame:
    """``df`` with ``next_<column>`` of the row that follows in descending order of the key, the first after the last.

    Rows of equal keys stand by a hash of those of the columns that ``df`` has, so ties have one result; null keys come last.

    ``more`` are further columns to compute, once for each row, that may be among ``columns``.

    Rows are dealt to blocks of the key's range, so that each row is moved once; only the highest row of a block is also
    sent to the next block above it, whose last row it follows.
    """
    n = df.count()
    if n == 0:
        df = df.withColumns(more or {})
        return df.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    blocks = min(MOST_BLOCKS, fit_rows(n, rows_per_block))
    cuts = min(256, blocks)
    quantiles = [(i + 1) / cuts for i in range(cuts - 1)] or [0.5]
    found = df.agg(F.percentile_approx(key, quantiles, 100 * cuts).alias("q"), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    bounds = [found.lo, *(found.q if cuts > 1 else []), found.hi] if found.lo is not None else [0, 0]
    parts = fit_rows(blocks, cuts)  # equal parts of the key's range between two cuts

    def block_of(k: Column) -> Column:
        inner = F.array(*[F.lit(int(x)) for x in bounds[1:-1]]).cast("array<bigint>")
        cut = F.size(F.filter(inner, lambda x: x <= k))
        ends = F.array(*[F.lit(int(x)) for x in bounds]).cast("array<bigint>")
        low, high = F.get(ends, cut).cast("double"), F.get(ends, cut + 1).cast("double")
        part = F.floor((k.cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * parts)
        place = F.least(F.greatest(part, F.lit(0)), F.lit(parts - 1)).cast("int")
        return F.when(k.isNull(), F.lit(-1)).otherwise(cut * parts + place)

    rows = df.withColumn("__block", block_of(F.col(key)))
    heads = rows.groupBy("__block").agg(F.max(key).alias("__key"))
    above = F.lead("__block").over(Window.orderBy("__block"))
    lowest = heads.agg(F.min("__block")).scalar()
    # one row per block, at most MOST_BLOCKS and a few
    edges = F.broadcast(heads.select("__key", F.coalesce(above, lowest).alias("__to")))
    copies = rows.join(edges, rows[key].eqNullSafe(edges["__key"])).drop("__key", "__block").withColumnRenamed("__to", "__block")
    both = rows.withColumn("__copy", F.lit(0)).unionByName(copies.withColumn("__copy", F.lit(1)))
    both = both.withColumns(more or {})
    ties = [F.xxhash64(c) for c in columns if c in df.columns]
    order = Window.partitionBy("__block").orderBy("__copy", F.col(key).desc_nulls_last(), *ties)
    following = both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return following.filter("__copy = 0").drop("__copy", "__block")


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    own = documents(spark, sf_dir).select("doc_id", text.alias("text"))
    rows = with_next(own, "doc_id", ["text", "sketch"], {"sketch": sketch(F.col("text"))})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "sketch", "next_sketch", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited")).alias("edited_sketch"))
    mine, other, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")

    def derive(e: Column) -> Column:
        return F.struct(
            as_text(e).alias("edited_fingerprint"), resemblance(mine, e).alias("near_edited"),
            containment(mine, e).alias("kept_share"), distinct_shingles(e).alias("edited_shingles"),
        )

    rows = rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(mine).alias("fingerprint"), bind(other, derive).alias("d"),
        resemblance(mine, following).alias("near_next"), distinct_shingles(mine).alias("shingles"),
    )
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "near_next", "shingles", "d.*")


QUERIES = {"op3_fingerprints": _query}
