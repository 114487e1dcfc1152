"""Hierarchical residual packing of pieces into sequences of a fixed capacity.

Partitions pack their items best-fit, longest first.  Nearly full bins leave; the underfull ones become items of the
next round, in fewer partitions, and so on up a tree until one partition is left or a round no longer saves bins.
Items of the full capacity are bins of their own and never enter a round.  A partition holds a bounded number of
items, whatever the size of the table.

Null texts count as empty: one piece that holds the closing id only.  Repeated rows are items of their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import session
from larder.llm import chunks, tokenizers_
from larder.llm.common import by_bytes, documents, fit_rows, spans, text_array

#: Items that one task packs at a time: about 20 bytes each, with their members.
ITEMS_PER_TASK = 200_000
_BIN = "bin long, used int, items binary, lengths binary, done boolean"
_BIN_ARROW = pa.schema([("bin", pa.int64()), ("used", pa.int32()), ("items", pa.binary()), ("lengths", pa.binary()), ("done", pa.bool_())])


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: longest first, each into the fullest open bin with room for it."""
    bins = np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free room
    rooms, count = 0, 0  # a bit for each free room that some bin has
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, chosen, count = capacity, count, count + 1
        left = room - length
        open_bins[left].append(chosen)
        rooms |= 1 << left
        bins[item] = chosen
    return bins


def _round(number: int, capacity: int, room: int):
    """A task's round: packs its rows, and marks bins with at most ``room`` left as done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([b for b in batches if len(b)] or [pa.RecordBatch.from_pylist([], schema=_BIN_ARROW)])
        used = table["used"].to_numpy()
        if len(used) == 0:
            return
        bins = best_fit(used, capacity)
        order = np.argsort(bins, kind="stable")
        totals = np.bincount(bins, weights=used).astype(np.int32)
        cuts = spans(np.bincount(bins)).tolist()
        items, lengths, order = table["items"].to_pylist(), table["lengths"].to_pylist(), order.tolist()
        first = (number << 56) | (TaskContext.get().partitionId() << 32)
        groups = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        columns = [
            pa.array(first + np.arange(len(groups))), pa.array(totals),
            pa.array([b"".join([items[i] for i in g]) for g in groups], pa.binary()),
            pa.array([b"".join([lengths[i] for i in g]) for g in groups], pa.binary()),
            pa.array(capacity - totals <= room),
        ]
        out = pa.Table.from_arrays(columns, schema=_BIN_ARROW)
        yield from out.to_batches(max_chunksize=10_000)

    return run


def _as_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items as bins of one member."""
    for batch in batches:
        item, length = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        one = lambda values, size: pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(values), [None, pa.py_buffer(values.tobytes())]).cast(pa.binary())
        columns = [pa.array(item), pa.array(length), one(item.astype("<i8"), 8), one(length.astype("<i4"), 4), pa.array(np.zeros(len(item), bool))]
        yield pa.RecordBatch.from_arrays(columns, schema=_BIN_ARROW)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, sequence_id, offset) of the members of bins."""
    for batch in batches:
        for at in range(0, len(batch), 1000):
            part = batch.slice(at, 1000)
            lengths = [np.frombuffer(x, "<i4") for x in part.column("lengths").to_pylist()]
            items = np.frombuffer(b"".join(part.column("items").to_pylist()), "<i8")
            offsets = np.concatenate([spans(x)[:-1] for x in lengths]) if lengths else np.zeros(0, np.int64)
            sequence = np.repeat(part.column("bin").to_numpy(), [len(x) for x in lengths])
            yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(sequence), pa.array(offsets)], names=["item", "sequence_id", "offset"])


def pack(items: DataFrame, capacity: int, length: str = "length", nearly_full: float = 1 / 256) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: at most ``capacity`` in a sequence, without gaps from 0.

    Lengths are between 1 and ``capacity``.  ``nearly_full`` is the share of the capacity that may stay free in a bin
    that leaves before the last round.  Columns of the two output names, and one named ``__item``, are not kept.
    """
    spark = items.sparkSession
    kept = [c for c in items.columns if c not in ("sequence_id", "offset", "__item")]
    items = session.materialise(items.select(*kept, F.monotonically_increasing_id().alias("__item")), "packing-items")
    is_full = F.col(length) == capacity
    full = items.filter(is_full).select(F.col("__item").alias("item"), F.col("__item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.filter(~is_full).select(F.col("__item").alias("item"), F.col(length).cast("int").alias("length")).mapInArrow(_as_bins, _BIN)
    waiting, finished, number = items.filter(~is_full).count(), [], 1
    tasks = fit_rows(waiting, ITEMS_PER_TASK // 4)
    while waiting:
        dealt = rest.repartition(tasks, F.xxhash64("items")) if tasks > 1 else rest.repartition(1)
        room = int(capacity * nearly_full) if tasks > 1 else capacity
        bins = session.materialise(dealt.mapInArrow(_round(number, capacity, room), _BIN), f"packing-round-{number}")
        left = bins.filter("not done").count()
        stuck = left > 0.98 * waiting  # the bins cannot be combined any more
        finished.append(bins if stuck else bins.filter("done"))
        rest, waiting, number = bins.filter("not done"), 0 if stuck else left, number + 1
        tasks = fit_rows(left, ITEMS_PER_TASK)
    places = full
    for bins in finished:
        # a sequence of a round never has the number of a full piece, as rounds start at 1 << 56
        places = places.union(bins.select("bin", "items", "lengths").mapInArrow(_members, "item long, sequence_id long, offset long"))
    joined = items.join(places, items["__item"] == places["item"])
    return joined.select(*[items[c] for c in kept], "sequence_id", "offset")


def pieces(df: DataFrame, vocabulary: str, capacity: int, closing_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids_crc32): each document's ids and the closing id, cut only beyond the capacity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tokenizers_.word_end(vocabulary)  # lower case, so capitals are no chunks of their own
        closing = np.array([closing_id], "<u4").tobytes()
        for batch in by_bytes(batches, 1):
            ids, offsets = table.ids_of(chunks.by_white_space(pc.ascii_lower(text_array(batch.column(1)))))
            sizes = np.diff(offsets) + 1
            raw, rows = memoryview(ids.astype("<u4").tobytes()), -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), rows)
            piece = np.arange(len(row)) - spans(rows)[:-1][row]
            start = piece * capacity
            length = np.minimum(capacity, sizes[row] - start)
            a, last = 4 * (offsets[:-1][row] + start), start + length == sizes[row]
            b = a + 4 * (length - last)
            crc = [zlib.crc32(closing, zlib.crc32(raw[i:j])) if z else zlib.crc32(raw[i:j]) for i, j, z in zip(a.tolist(), b.tolist(), last.tolist(), strict=True)]
            columns = [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "piece", "start", "length", "ids_crc32"])

    schema = T.StructType([df.schema[key], T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))])
    return df.select(key, text).mapInArrow(run, schema)


def packed_documents(df: DataFrame, vocabulary: str, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of whole documents."""
    return pack(pieces(df, vocabulary, capacity), capacity)


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op1_packing": _query}
