"""Thresholds for boundary characters of keywords, and their use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import numbers
from larder.operators import keywords

# The shortest keyword, the grid, and which of its points is the
# threshold for keywords longer than, or up to, LONG_KEYWORD characters.
MIN_LENGTH = 3
GRID_POINTS = 100
LONG_KEYWORD = 5
LONG_POINT = 1
SHORT_POINT = 5


def thresholds(bounds: DataFrame, term: str, min_length: int = MIN_LENGTH) -> DataFrame:
    """(length, threshold) with the statistics it follows from.

    The threshold is a point of the grid from -max to -min of the negative
    terms.  All lengths come from one aggregation.
    """
    stats = keywords.length_stats(bounds, term).filter(F.col("length") >= min_length)
    point = F.when(F.col("length") > LONG_KEYWORD, LONG_POINT).otherwise(SHORT_POINT)
    value = numbers.grid_point(-F.col("term_max"), -F.col("term_min"), point, GRID_POINTS)
    return stats.withColumn("threshold", value)


def term_thresholds(corpus: DataFrame, column: str) -> DataFrame:
    """(length, first_threshold, last_threshold) of a keyword corpus."""
    bounds = keywords.boundary_terms(corpus, column, keywords.pair_terms(keywords.frequency_tables(corpus, column)))
    return both_thresholds(bounds)


def both_thresholds(bounds: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Both thresholds from one aggregation over the boundary terms."""
    ends = bounds.select(
        "length", F.explode(F.array(*[_end(e) for e in ("first", "last")])).alias("e")
    ).select("length", "e.end", "e.term")
    negative = F.when(F.col("term") < 0.0, F.col("term"))
    stats = ends.filter(F.col("length") >= min_length).groupBy("length", "end").agg(
        F.min(negative).alias("term_min"), F.max(negative).alias("term_max")
    )
    point = F.when(F.col("length") > LONG_KEYWORD, LONG_POINT).otherwise(SHORT_POINT)
    value = numbers.grid_point(-F.col("term_max"), -F.col("term_min"), point, GRID_POINTS)
    per_end = [F.max(F.when(F.col("end") == e, F.col("value"))).alias(f"{e}_threshold") for e in ("first", "last")]
    return stats.withColumn("value", value).groupBy("length").agg(*per_end)


def _end(name: str):
    return F.struct(F.lit(name).alias("end"), F.col(f"{name}_term").alias("term"))


def refine_keywords(corpus: DataFrame, column: str) -> DataFrame:
    """Drop a boundary character whose -term is below the threshold for the
    keyword's length; keywords without a threshold stay as they are."""
    bounds = keywords.boundary_terms(corpus, column, keywords.pair_terms(keywords.frequency_tables(corpus, column)))
    return apply_thresholds(bounds, both_thresholds(bounds))


def apply_thresholds(bounds: DataFrame, limits: DataFrame) -> DataFrame:
    """Refined keywords from boundary terms and a threshold table."""
    rows = bounds.join(limits, "length", "left")
    cut_first = F.coalesce(-F.col("first_term") < F.col("first_threshold"), F.lit(False))
    cut_last = F.coalesce(-F.col("last_term") < F.col("last_threshold"), F.lit(False))
    start = F.when(cut_first, 2).otherwise(1)
    width = F.col("length") - cut_first.cast("int") - cut_last.cast("int")
    return rows.select(
        "keyword",
        cut_first.alias("drop_first"),
        cut_last.alias("drop_last"),
        F.substring(F.col("condensed"), start, width).alias("refined"),
    )
