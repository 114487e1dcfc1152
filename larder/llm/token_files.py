"""Token ids in binary segments: Simple-8b coding in 64-bit words.

A word holds a selector in its upper four bits and 60 bits of data: 60 ids of one bit, 30 of two, ... or one of 60.
Selector 15 is an escape: the next word is one value of up to 64 bits.  Ids are coded in blocks of 1,024; a segment
lists the place of each block's first word, so all blocks are coded and decoded side by side by array operations.

A segment is one row of a Spark table: a directory (document ids, lengths, block offsets) and the words.  Spark's
writer commits whole tasks, so a lost executor leaves no half-written file.  Rows with equal ids are ordered by a
hash of their text; null ids come first; null texts are empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder import session
from larder.llm import chunks, tokenizers_
from larder.llm.common import by_bytes, documents, spans, text_array

BLOCK = 1024
#: (ids in a word, bits of each) by selector; selector 15 is the escape.
LAYOUTS = [(n, 60 // n) for n in (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)]
_ESCAPE = 15


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs; at most one more beyond 2^53, where a float rounds up."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The words of some unsigned integers, and the place of each block's first word (one more place at the end)."""
    n = len(values)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    values = values.astype(np.uint64)
    blocks = -(-n // block)
    padded = np.zeros((blocks + 1) * block + 64, np.uint64)
    padded[:n] = values
    # the selector at each place: the widest layout in which the following ids fit, zeros following the last id
    bits = _bit_lengths(padded[: blocks * block]).reshape(blocks, block)
    bits = np.concatenate([bits, np.zeros((blocks, 64), np.uint8)], axis=1)
    choice = np.full((blocks, block), _ESCAPE, np.uint8)
    widest, counted = np.zeros((blocks, block), np.uint8), 0
    for selector in range(len(LAYOUTS) - 1, -1, -1):
        count, width = LAYOUTS[selector]
        while counted < count:
            np.maximum(widest, bits[:, counted : counted + block], out=widest)
            counted += 1
        fits = widest <= width
        if not fits.any():
            break
        choice[fits] = selector
    takes = np.array([c for c, _ in LAYOUTS] + [0, 1], np.int64)
    # one word of every block at a time
    at, rows, steps = np.zeros(blocks, np.int64), np.arange(blocks), []
    sizes = np.minimum(block, n - rows * block)
    while len(rows):
        chosen = choice[rows, at[rows]]
        steps.append((rows, at[rows].copy(), chosen))
        at[rows] += takes[chosen]
        rows = rows[at[rows] < sizes[rows]]
    row = np.concatenate([s[0] for s in steps])
    order = np.argsort(row, kind="stable")
    place = (row * block + np.concatenate([s[1] for s in steps]))[order]
    chosen, row = np.concatenate([s[2] for s in steps])[order], row[order]
    width = np.where(chosen == _ESCAPE, 2, 1)
    first = spans(width)
    words = np.zeros(first[-1], np.uint64)
    limit = np.minimum((place // block + 1) * block, n)
    for selector, (count, size) in enumerate(LAYOUTS):
        own = np.flatnonzero(chosen == selector)
        if len(own) == 0:
            continue
        word = np.full(len(own), selector << 60, np.uint64)
        for k in range(count):
            inside = place[own] + k < limit[own]
            word |= np.where(inside, padded[place[own] + k], np.uint64(0)) << np.uint64(size * k)
        words[first[own]] = word
    own = np.flatnonzero(chosen == _ESCAPE)
    words[first[own]], words[first[own] + 1] = np.uint64(_ESCAPE << 60), padded[place[own]]
    per_block = np.bincount(row, weights=width, minlength=blocks).astype(np.int64)
    return words, spans(per_block)


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` integers that ``pack`` coded."""
    out = np.zeros(n, np.uint64)
    if n == 0:
        return out
    selectors = (words >> np.uint64(60)).astype(np.int64)
    # a word after an escape is data, whatever it looks like: in a run of look-alikes every other one is an escape
    alike, index = selectors == _ESCAPE, np.arange(len(words))
    begins = alike & ~np.concatenate([[False], alike[:-1]])
    escape = alike & ((index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 0)
    selectors[np.flatnonzero(escape) + 1] = -1
    takes = np.array([c for c, _ in LAYOUTS] + [0, 1, 0], np.int64)[selectors]  # the last for data words, at -1
    block_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    upto = spans(takes)
    start = block_of * block + upto[:-1] - upto[offsets[:-1]][block_of]
    limit = np.minimum((block_of + 1) * block, n)
    for selector, (count, size) in enumerate(LAYOUTS):
        own = np.flatnonzero(selectors == selector)
        mask = np.uint64((1 << size) - 1)
        for k in range(count if len(own) else 0):
            inside = start[own] + k < limit[own]
            out[(start[own] + k)[inside]] = ((words[own] >> np.uint64(size * k)) & mask)[inside]
    own = np.flatnonzero(selectors == _ESCAPE)
    out[start[own]] = words[own + 1]
    return out


def _segments(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part = tokenizers_.byte_level(vocabulary), TaskContext.get().partitionId()
        for number, batch in enumerate(by_bytes(batches, 1)):
            ids, offsets = table.ids_of(chunks.before_spaces(text_array(batch.column(1))))
            lengths = np.diff(offsets) + 1
            ends = np.cumsum(lengths)
            whole = np.full(ends[-1], end_id, np.uint32)
            inner = np.ones(len(whole), bool)
            inner[ends - 1] = False
            whole[inner] = ids
            words, places = pack(whole)
            row = {
                "part": [part], "number": [number], "n_ids": [len(whole)],
                "doc_ids": [batch.column(0).to_pylist()], "lengths": [lengths],
                "block_offsets": [places.astype("<i8").tobytes()], "words": [words.astype("<u8").tobytes()],
            }
            yield pa.RecordBatch.from_pydict(row, schema=_ARROW)

    return run


_ARROW = pa.schema(
    [("part", pa.int32()), ("number", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("block_offsets", pa.binary()), ("words", pa.binary())]
)
_SCHEMA = "part int, number int, n_ids long, doc_ids array<long>, lengths array<long>, block_offsets binary, words binary"


def write(df: DataFrame, path: str, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode texts and write their ids as segments, in ascending order of the key over parts and segment numbers."""
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    # ranges are drawn from samples of the key and the hash alone: no text goes to the driver
    ordered = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")
    rows = ordered.mapInArrow(_segments(vocabulary, end_id), _SCHEMA)
    rows.write.option("compression", "none").parquet(path)


def _starts(segments: DataFrame) -> DataFrame:
    """(part, number, base): ids in all segments before.  Parts are added up first, so no task reads all segments."""
    sizes = segments.select("part", "number", "n_ids")
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    parts = parts.select("part", before(Window.orderBy("part")).alias("earlier"))
    own = sizes.withColumn("own", before(Window.partitionBy("part").orderBy("number")))
    return own.join(parts, "part").select("part", "number", (F.col("earlier") + F.col("own")).alias("base"))


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(part, number, doc_id, place in the segment, n_tokens, ids) and the segments' starts; ``ids`` are little-endian 32-bit integers."""
    segments = spark.read.schema(_SCHEMA).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, places = np.frombuffer(row["words"], "<u8"), np.frombuffer(row["block_offsets"], "<i8")
                ids = unpack(words, places, row["n_ids"]).astype("<u4")
                upto = spans(np.array(row["lengths"], np.int64))
                own = [ids[a:b].tobytes() for a, b in zip(upto[:-1], upto[1:], strict=True)]
                same = lambda v: pa.array(np.full(len(own), v, np.int32))  # noqa: B023, E731
                columns = [same(row["part"]), same(row["number"]), pa.array(row["doc_ids"], pa.int64()), pa.array(upto[:-1]), pa.array(np.diff(upto)), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "number", "doc_id", "place", "n_tokens", "ids"])

    found = segments.select("part", "number", "n_ids", "doc_ids", "lengths", "block_offsets", "words")
    return found.mapInArrow(run, "part int, number int, doc_id long, place long, n_tokens long, ids binary"), _starts(segments)


def documents_of(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of written segments; only these narrow rows meet the segments' starts."""
    rows, starts = read(spark, path)
    narrow = rows.select("part", "number", "doc_id", "place", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    placed = narrow.join(starts, ["part", "number"])
    return placed.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = session.scratch_path(spark, "token-files")
    write(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return documents_of(spark, path)


QUERIES = {"op8_token_files": _query}
