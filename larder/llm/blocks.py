"""Blocks of documents that answers from elsewhere can be brought back to.

Some operators ask the whole corpus about a document's parts (is this word sequence elsewhere, how often is this pair
seen) and need the answers beside the text.  Asked row by row, every part would be moved with its document's key; asked
by block, a part is asked once a block, as packed sorted arrays, and an answer is one bit or number at the same place.

A block is one row of a written table, so its name and content stay the same through retries: (block long, ids array of
long, texts array of string).  A text longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import session
from larder.llm.common import by_bytes

#: Bytes of text in a block.
BLOCK_BYTES = 4 << 20
#: Null keys count as the largest.
NULL_KEY = np.iinfo(np.int64).max

_ARROW = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("texts", pa.list_(pa.string()))])


def written(df: DataFrame, key: str, text: str, name: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The key (cast to long) and text of all rows as a written table of blocks; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(by_bytes(batches, 1, block_bytes)):
            row = [pa.array([first + number])]
            for column in batch.columns:
                values = column.fill_null("") if pa.types.is_string(column.type) else column
                row.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            yield pa.RecordBatch.from_arrays(row, schema=_ARROW)

    own = df.select(F.col(key).cast("long"), F.col(text).cast("string"))
    return session.materialise(own.mapInArrow(run, "block long, ids array<long>, texts array<string>"), name)


def ids_of(column: pa.Array, row: int) -> np.ndarray:
    """The keys of one block, null as the largest."""
    return pc.fill_null(column[row].values, NULL_KEY).to_numpy(zero_copy_only=False)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes, and the offsets of the texts in it."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a line end after each, so that no word goes on, as bytes, and where each begins."""
    raw, offsets = bytes_of(texts)
    data, inner = np.full(len(raw) + len(texts), 0x0A, np.uint8), np.ones(len(raw) + len(texts), bool)
    inner[offsets[1:] + np.arange(len(texts))] = False
    data[inner] = raw
    return data, offsets[:-1] + np.arange(len(texts))


def flags_of(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def shards_for(items: int, per_shard: int, least: int = 32) -> int:
    """A power of two that gives each shard about ``per_shard`` items at most."""
    return 1 << max(int(least).bit_length() - 1, int(np.ceil(np.log2(max(1, items) / per_shard))))


def cuts_of(ascending: np.ndarray, shards: int) -> np.ndarray:
    """Where the shards, by the upper bits, begin among ascending 64-bit hashes; one more place at the end."""
    bits = shards.bit_length() - 1
    return np.append(np.searchsorted(ascending >> np.uint64(64 - bits), np.arange(shards, dtype=np.uint64)), len(ascending)) if bits else np.array([0, len(ascending)])


def narrow(hashes: np.ndarray, shards: int, size: int) -> np.ndarray:
    """The ``size`` bytes below the bits that name the shard, a row for each hash."""
    left = hashes << np.uint64(shards.bit_length() - 1)
    return (left >> np.uint64(64 - 8 * size)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]


def widened(packed: list[bytes], size: int) -> np.ndarray:
    """The integers of rows written by ``narrow``."""
    raw = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, size)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :size] = raw
    return out.view("<u8")[:, 0]


def answers(found: DataFrame, name: str) -> DataFrame:
    """(block, name): all answers to a block in the order of the shards.  A block has one from each shard at most."""
    own = F.sort_array(F.collect_list(F.struct("shard", "answer")))
    return found.groupBy("block").agg(F.transform(own, lambda a: a["answer"]).alias(name))
