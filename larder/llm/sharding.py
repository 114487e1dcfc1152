"""Sharding by a two-pass external shuffle.

Pass one scatters records uniformly into memory-sized buckets by seeded hashes; pass two shuffles each bucket
(Spark's ``shuffle`` of an array is Fisher-Yates) and writes it.  The shard of a record is the one of the highest
seeded hash of its key and the shard's number, so a further shard takes records only into itself (law ``key``).
The text is moved once.  A bucket is sized by bytes, never by key: records are spread by key, content and place.

Null keys are a key of their own; null and empty texts count no bytes.  Repeated rows keep their own slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import session
from larder.llm.common import documents, fit_rows

#: Bytes of text in a bucket: an array of its records fits in a task several times.
BUCKET_BYTES = 8 << 20


def shard_of(key: Column, shards: int, seed: int = 42) -> Column:
    """The shard of a key among ``shards``: the highest of as many hashes."""
    rank = lambda s: F.struct(F.xxhash64(F.lit(seed), key, s).alias("h"), s.alias("s"))
    return F.array_max(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), rank))["s"]


def write(df: DataFrame, path: str, shards: int, key: str = "doc_id", text: str = "text", seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``df`` in shuffled shards, folders ``shard=N``, and return the written rows (record, bucket, place, shard).

    ``record`` holds all columns of ``df``, so their names cannot clash with those added.
    """
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = fit_rows(total, bucket_bytes * shards)
    record = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("record"))
    own_key, own_text = F.col("record")[key], F.col("record")[text]
    spread = F.xxhash64(F.lit(seed + 1), own_key, own_text, F.monotonically_increasing_id())
    order = F.xxhash64(F.lit(seed + 2), own_key, own_text)
    scattered = record.select("record", shard_of(own_key, shards, seed).alias("shard"), F.pmod(spread, F.lit(buckets)).alias("bucket"), order.alias("h"))
    scattered = scattered.repartition(shards * buckets, "shard", "bucket").sortWithinPartitions("shard", "bucket", "h")
    gathered = scattered.groupBy("shard", "bucket").agg(F.collect_list("record").alias("records"))
    # the order of records in a bucket and of buckets in a task is fixed, hence so is the shuffle
    mixed = gathered.sortWithinPartitions("shard", "bucket").select("shard", "bucket", F.shuffle("records", seed).alias("records"))
    placed = mixed.select("shard", "bucket", F.posexplode("records").alias("place", "record"))
    placed.write.partitionBy("shard").parquet(path)
    schema = T.StructType([*(placed.schema[c] for c in ("record", "bucket", "place")), T.StructField("shard", T.IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(path)


def slots(written: DataFrame, *columns: str | Column) -> DataFrame:
    """The columns of written rows, their shard and slot; slots are gapless from 0 in each shard."""
    sizes = written.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = written.select("bucket", "place", "shard", *columns).join(bases, ["shard", "bucket"])
    return rows.withColumn("slot", F.col("base") + F.col("place")).drop("bucket", "place", "base")


def digest(written: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of written documents."""
    text = F.coalesce(F.col("record.text"), F.lit(""))
    size, crc = (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    rows = slots(written, F.col("record.doc_id").alias("doc_id"), size, crc)
    grown = shard_of(F.col("doc_id"), shards + 1).cast("int")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", grown.alias("grown_shard"))


def _query(spark: SparkSession, sf_dir: str, shards: int = 24) -> DataFrame:
    written = write(documents(spark, sf_dir).select("doc_id", "text"), session.scratch_path(spark, "shards"), shards)
    return digest(written, shards)


QUERIES = {"op10_sharding": _query}
