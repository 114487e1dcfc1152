"""Keyword statistics: frequency tables and conditional-entropy terms.

A keyword is condensed (white space removed) and read as a row of characters
``c1 c2 … cn``.  With ``N`` the number of all tokens,

    term_i  = p(ci ci+1) * log2 p(ci+1 | ci)
    p(xy)   = count(xy) / N        p(y | x) = count(xy) / count(x)
    entropy = - sum of the terms

Counts live in tables that are joined; no dictionary is built on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import text


def _pieces(word: Column, size: int) -> Column:
    """All runs of ``size`` neighbouring characters, in order."""
    last = F.length(word) - (size - 1)
    starts = F.sequence(F.lit(1), F.greatest(last, F.lit(1)))
    return F.when(last >= 1, F.transform(starts, lambda i: F.substring(word, i, F.lit(size)))).otherwise(
        F.array().cast("array<string>")
    )


@dataclass(frozen=True)
class FrequencyTables:
    """The five count tables of a keyword corpus."""

    token2count: DataFrame
    count2token_num: DataFrame
    cooccur2count: DataFrame
    count2cooccur_num: DataFrame
    token_count_sum: DataFrame


def piece_counts(corpus: DataFrame, column: str, size: int, out: str) -> DataFrame:
    pieces = corpus.select(F.explode(_pieces(text.condense(column), size)).alias(out))
    return pieces.groupBy(out).agg(F.count("*").alias("count"))


def frequency_tables(corpus: DataFrame, column: str) -> FrequencyTables:
    token2count = piece_counts(corpus, column, 1, "token")
    cooccur2count = piece_counts(corpus, column, 2, "cooccur")
    return FrequencyTables(
        token2count,
        token2count.groupBy("count").agg(F.count("*").alias("n_token")),
        cooccur2count,
        cooccur2count.groupBy("count").agg(F.count("*").alias("n_occur")),
        token2count.agg(F.sum("count").alias("token_count_sum")),
    )


def pair_terms(tables: FrequencyTables) -> DataFrame:
    """(cooccur, term) for every pair of neighbouring characters."""
    total = tables.token_count_sum.scalar().cast("double")
    pairs = tables.cooccur2count.withColumn("token", F.substring("cooccur", 1, 1))
    firsts = tables.token2count.withColumnRenamed("count", "token_count")
    n, first = F.col("count").cast("double"), F.col("token_count").cast("double")
    return pairs.join(firsts, "token").select("cooccur", (n / total * F.log2(n / first)).alias("term"))


def keyword_terms(keywords: DataFrame, column: str, terms: DataFrame) -> DataFrame:
    """Entropy and term list of each distinct keyword.

    The list is as long as the keyword, which bounds what is gathered per row.
    Keywords of fewer than two characters have no terms and entropy 0.
    """
    words = keywords.select(F.col(column).alias("keyword")).filter("keyword is not null").distinct()
    pieces = words.select("keyword", F.posexplode_outer(_pieces(text.condense("keyword"), 2)).alias("position", "cooccur"))
    found = pieces.join(terms, "cooccur", "left").groupBy("keyword").agg(
        F.coalesce(-F.sum("term"), F.lit(0.0)).alias("entropy"),
        F.array_sort(F.collect_list(F.when(F.col("term").isNotNull(), F.struct("position", "term")))).alias("__t"),
    )
    return found.select("keyword", "entropy", F.transform("__t", lambda t: t["term"]).alias("terms"))


def first_and_last_term(df: DataFrame, terms: str = "terms") -> DataFrame:
    """The outer terms; null where there are none."""
    return df.withColumns({"first_term": F.try_element_at(terms, F.lit(1)), "last_term": F.try_element_at(terms, F.lit(-1))})


def boundary_terms(keywords: DataFrame, column: str, terms: DataFrame) -> DataFrame:
    """(keyword, condensed, length, first_term, last_term) per distinct keyword.

    Only the outer pairs are looked up, so nothing is exploded or regrouped.
    Keywords of fewer than two characters stay, without terms.
    """
    words = (
        keywords.select(F.col(column).alias("keyword"))
        .filter("keyword is not null")
        .distinct()
        .withColumn("condensed", text.condense("keyword"))
        .withColumn("length", F.length("condensed"))
    )
    first = terms.select(F.col("cooccur").alias("__f"), F.col("term").alias("first_term"))
    last = terms.select(F.col("cooccur").alias("__l"), F.col("term").alias("last_term"))
    return (
        words.withColumn("__f", F.substring("condensed", 1, 2))
        .withColumn("__l", F.substring("condensed", -2, 2))
        .join(first, "__f", "left")
        .join(last, "__l", "left")
        .drop("__f", "__l")
    )


def length_stats(bounds: DataFrame, term: str) -> DataFrame:
    """Statistics of a boundary term per keyword length, in one pass.

    Minimum and maximum look at negative terms only.
    """
    negative = F.when(F.col(term) < 0.0, F.col(term))
    return bounds.filter("length >= 2").groupBy("length").agg(
        F.avg(term).alias("term_avg"),
        F.stddev(term).alias("term_stddev"),
        F.min(negative).alias("term_min"),
        F.max(negative).alias("term_max"),
    )
