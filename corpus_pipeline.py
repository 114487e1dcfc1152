"""The corpus pipeline: quality rules, toxicity, near-duplicates, secrets, packing.

Every stage reads what the one before it wrote and keeps whole rows; the last one packs the texts that are left.
Columns of the documents are carried as one struct inside a stage, so their names cannot clash with a stage's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import session
from larder.llm import near_copies, packing, quality, secrets, toxicity

#: Bits in which the fingerprints of near copies may differ.
RADIUS = 2


def _whole(docs: DataFrame) -> DataFrame:
    """The text, and all columns as ``doc``."""
    return docs.select("text", F.struct(*[F.col(c) for c in docs.columns]).alias("doc"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass version 2 of the policy; null and empty texts do not."""
    return quality.ledger(_whole(docs), keep=("doc",)).filter(quality.passes(2)).select("doc.*")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model learned from the labelled training rows among them does not call toxic."""
    model, _ = toxicity.fit_and_vote(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    votes = toxicity.cast_votes(_whole(docs), model.lexicon, "doc")
    return votes.filter(model.score() < toxicity.THRESHOLD).select("doc.*")


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the first by id and a hash of the text; repeated rows are one.

    Texts are linked by the SimHash operator, and by their exact resemblance where their fingerprints differ in more bits.

    Rows of an id and a text share their fate; only those that stay and are repeated are moved whole to drop the repeats.
    """
    copies = near_copies.near_copies(docs, "doc_id", radius=RADIUS)
    fate = copies.groupBy("key", "tie").agg(F.max("rank").alias("rank"), F.count("*").alias("n"))
    first = fate.filter("rank = 1").select(F.col("key").alias("__key"), F.col("tie").alias("__tie"), "n")
    tie = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    kept = _whole(docs).join(first, F.col("doc.doc_id").eqNullSafe(F.col("__key")) & (tie == F.col("__tie")))
    once = kept.filter("n = 1").select("doc")
    repeated = kept.filter("n > 1").dropDuplicates(["__key", "__tie"]).select("doc")
    return once.union(repeated).select("doc.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with owner-specific live-looking secrets replaced and ``n_chars`` set to the new length."""
    tie = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    scanned = secrets.scanned_table(docs.withColumn("__tie", tie), ["doc_id", "__tie"])
    live = F.filter("judged", lambda s: s["verdict"] == "live")
    found = secrets.judge(scanned).withColumn("live", live).filter(F.size("live") > 0)
    # spans are those of a text: rows of equal id and text have the same, from any of them
    found = found.groupBy(F.col("doc_id").alias("__id"), "__tie").agg(F.first("live").alias("__live"))
    rows = docs.withColumn("__own", tie).join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__tie")), "left")
    hit = F.col("__live").isNotNull()
    clean = F.when(hit, secrets.redact(F.col("text"), F.col("__live"))).otherwise(F.col("text"))
    new = {"text": clean.alias("text"), "n_chars": F.when(hit, F.length(clean)).otherwise(F.col("n_chars")).cast("long").alias("n_chars")}
    return rows.select(*[new.get(c, F.col(c)) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all that is left."""
    import public_tokenizers

    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("toxicity", not_toxic),
    ("near_duplicates", no_near_copies),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: Toxicity, near-duplicates and packing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = session.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
