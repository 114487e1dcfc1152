"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints within a small radius agree exactly in some of their pieces, so candidates meet in buckets of equal
pieces; the number of pieces follows the number of distinct fingerprints, which keeps chance meetings few at any size.
Within a bucket the fingerprints stand as 64 vertical bit planes: 64 of them in a machine word for each plane.  The
distances of a query to all of them grow plane by plane in carry-save counters, and words in which every distance is
beyond the radius are abandoned.  A bucket sends the links of a spanning forest, never all its pairs; larger buckets
are cut into blocks that are compared pair by pair.  Equal fingerprints are one node, however many rows have them.

Near copies of the pipeline, linked by the resemblance of their shingles itself, are in ``near_copies``.

Null and empty texts have fingerprint zero and link like any other.  Null keys take part; a component is named by its
smallest key, nulls aside.  Repeated rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import session
from larder.llm.common import by_bytes, documents, spans, text_array

BITS = 64
#: Rows of a block of a large bucket: two blocks are compared in one task.
BLOCK_ROWS = 32_768
#: Pairs of a query and a word that are compared at a time.
LANES = 65_536


def shingle_hashes(words: list[bytes], shingle: int, seed: int = 42) -> list[int]:
    """Hashes of all shingles of a text, repeats included; of the whole sequence where it has fewer words, if any."""
    from xxhash import xxh64_intdigest

    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxh64_intdigest(joined, seed)] if words else []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    return [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]


def majorities(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For runs of rows of 64-bit words, the bits that more than half the rows of a run have; none for an empty run."""
    out = np.zeros((len(sizes), hashes.shape[1]), "<u8")
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, spans(sizes)[full], axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > sizes[full, None], axis=1, bitorder="little").copy().view("<u8")
    return out


def fingerprints(texts: pa.Array, shingle: int, seed: int = 42) -> np.ndarray:
    """The fingerprints of a batch of texts."""
    # of bytes: A-Z in lower case, split at white space from space and U+0009 to U+000D
    hashes = [shingle_hashes(raw.lower().split(), shingle, seed) for raw in texts.cast(pa.binary()).to_pylist()]
    sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
    flat = np.array([h for own in hashes for h in own], np.uint64)
    return majorities(flat.reshape(-1, 1), sizes)[:, 0]


def with_fingerprint(df: DataFrame, keep: list[str], text: str = "text", shingle: int = 3, out: str = "fingerprint") -> DataFrame:
    """The kept columns and the fingerprint of each text, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, len(keep), 1 << 20):
            values = fingerprints(text_array(batch.column(len(keep))), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(len(keep))), pa.array(values)], names=[*keep, out])

    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.LongType())])
    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def _beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count, in bit-sliced counters, is above the radius."""
    more, equal = np.zeros_like(over), ~np.zeros_like(over)
    for j in range(len(counters) - 1, -1, -1):
        if radius >> j & 1:
            equal = equal & counters[j]
        else:
            more |= equal & counters[j]
            equal = equal & ~counters[j]
    return more | over


def near_pairs(values: np.ndarray, bounds: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of values at most ``radius`` bits apart, both in one run bounds[r]:bounds[r + 1].

    A value is a row of 64-bit words.
    """
    sizes = np.diff(bounds)
    words = -(-sizes // 64)
    run = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(values)) - bounds[:-1][run]
    first_word = spans(words)
    word, lane = first_word[run] + place // 64, (place % 64).astype(np.uint64)
    word_starts = np.flatnonzero(lane == 0)
    bit_of = lambda rows, b: (values[rows, b // BITS] >> np.uint64(b % BITS)) & np.uint64(1)
    planes = [np.add.reduceat(bit_of(slice(None), b) << lane, word_starts) for b in range(BITS * values.shape[1])]
    in_word = np.diff(np.append(word_starts, len(values)))
    valid = np.where(in_word == 64, ~np.uint64(0), (np.uint64(1) << (in_word % 64).astype(np.uint64)) - np.uint64(1))
    # a query meets the lanes after its own, in its own and the later words of its run
    jobs = first_word[1:][run] - word
    jobs[sizes[run] < 2] = 0
    queries = np.arange(len(values))
    upto = spans(jobs)
    start = 0
    while start < len(values):
        end = max(start + 1, int(np.searchsorted(upto, upto[start] + LANES, "right")) - 1)
        q = np.repeat(queries[start:end], jobs[start:end])
        w = word[q] + np.arange(len(q)) - (upto[q] - upto[start])
        alive = valid[w]
        own = w == word[q]
        alive[own] &= ~np.uint64(0) << lane[q[own]] << np.uint64(1) if own.any() else alive[own]
        counters, over = [np.zeros(len(q), np.uint64) for _ in range(radius.bit_length())], np.zeros(len(q), np.uint64)
        for b, plane in enumerate(planes):
            carry = plane[w] ^ (np.uint64(0) - bit_of(q, b))
            for j in range(len(counters)):
                counters[j], carry = counters[j] ^ carry, counters[j] & carry
            over |= carry
            if b % 4 == 3:
                alive &= ~_beyond(counters, over, radius)
                left = alive != 0
                if not left.all():
                    q, w, alive, over = q[left], w[left], alive[left], over[left]
                    counters = [c[left] for c in counters]
                if len(q) == 0:
                    break
        if len(q):
            lanes = np.unpackbits(alive.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
            row, bit = np.nonzero(lanes)
            yield q[row], word_starts[w[row]] + bit
        start = end


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the pairs."""
    parent = np.arange(n)
    for a, b in pairs:
        while True:
            parent = _roots(parent)
            a, b = parent[a], parent[b]
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
    return _roots(parent)


def _bucket_links(radius: int, width: int):
    """Links of rows (bucket, node, bits) sorted by bucket: reads runs of equal buckets, however they are cut into batches."""

    def solve(buckets: np.ndarray, nodes: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        bounds = np.append(np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])), len(buckets))
        several = np.repeat(np.diff(bounds) > 1, np.diff(bounds))
        nodes, bits = nodes[several], bits[several]
        sizes = np.diff(bounds)[np.diff(bounds) > 1]
        root = forest(len(nodes), near_pairs(bits, spans(sizes), radius)) if len(nodes) else np.zeros(0, np.int64)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[root[linked]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, width), np.uint64)
        for batch in batches:
            if len(batch) == 0:
                continue
            bits = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u8").reshape(-1, width)
            new = batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits
            held = tuple(np.concatenate(x) for x in zip(held, new, strict=True))
            cut = int(np.searchsorted(held[0], held[0][-1]))  # the last run may go on
            if cut:
                yield solve(*[x[:cut] for x in held])
                held = tuple(x[cut:] for x in held)
        if len(held[0]):
            yield solve(*held)

    return run


def tables_for(n: int, radius: int) -> list[int]:
    """Masks of the pieces that must agree: with more rows, more pieces agree, so that about 64 rows meet by chance."""
    wanted = max(1.0, np.log2(max(n, 1)) - 6)
    pieces = next(m for m in range(radius + 1, BITS + 1) if BITS * (m - radius) // m >= wanted)
    cuts = [BITS * i // pieces for i in range(pieces + 1)]
    bits = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [sum(own) for own in combinations(bits, pieces - radius)]


def links(nodes: DataFrame, radius: int, width: int = 1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(u, v): links that join all nodes that share a bucket and lie within the radius of each other.

    Nodes are (node long, bits binary of ``width`` 64-bit words, buckets array of long).
    """
    rows = nodes.select("node", "bits", F.explode("buckets").alias("bucket"))
    large = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > 2 * block_rows)
    cut = rows.join(large, "bucket", "left").withColumn("blocks", F.ceil(F.coalesce(F.col("n"), F.lit(1)) / block_rows))
    mine = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks"))
    cut = cut.select("node", "bits", "bucket", "blocks", mine.alias("mine"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    pair = F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other"))
    cut = cut.select(F.when(F.col("blocks") == 1, F.col("bucket")).otherwise(pair).alias("bucket"), "node", "bits")
    dealt = cut.repartition(F.col("bucket")).sortWithinPartitions("bucket", "node")
    return dealt.mapInArrow(_bucket_links(radius, width), "u long, v long").distinct()


def _narrow_nodes(values: DataFrame, radius: int) -> DataFrame:
    """Distinct 64-bit fingerprints (``value``) as nodes, with a bucket for each choice of pieces that must agree."""
    signed = lambda m: F.lit(m - (1 << BITS) if m >> (BITS - 1) else m).cast("long")
    # a bucket is a hash of the choice and the pieces; unequal pieces that meet by chance are compared in vain
    buckets = [F.xxhash64(F.lit(t), F.col("value").bitwiseAND(signed(m))) for t, m in enumerate(tables_for(values.count(), radius))]
    bits = F.unhex(F.lpad(F.hex("value"), 16, "0"))
    return values.select(F.col("value").alias("node"), bits.alias("bits"), F.array(*buckets).alias("buckets"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, by alternating large and small stars.

    Every node takes the least of its neighbours; no list of neighbours is gathered.  Each round is written to the
    shared folder; rounds end when the edges no longer change.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    down = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = session.materialise(edges.filter("u != v").select(*down).distinct(), "links")
    seen = state(edges)
    while seen[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = session.materialise(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = session.materialise(small.union(least).select(*down).distinct(), "links")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _named(rows: DataFrame, value: str, key: str, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the smallest key of each component; nodes are (node, value, least key)."""
    rooted = nodes.join(found.withColumnRenamed("node", "__node"), F.col("node") == F.col("__node"), "left")
    rooted = rooted.select("value", "least", F.coalesce("root", "node").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_value = rooted.join(names, "root").select(F.col("value").alias("__value"), "component_id")
    return rows.join(by_value, rows[value] == by_value["__value"]).drop("__value")


def component_of(rows: DataFrame, key: str, radius: int, value: str = "fingerprint", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``component_id``: the smallest key among all rows reachable by links within the radius."""
    nodes = session.materialise(rows.groupBy(F.col(value).alias("value")).agg(F.min(key).alias("least")), "fingerprints")
    found = components(links(_narrow_nodes(nodes.select("value"), radius), radius, 1, block_rows))
    return _named(rows, value, key, nodes.withColumn("node", F.col("value")), found)


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = session.materialise(with_fingerprint(documents(spark, sf_dir), ["doc_id"]), "simhash")
    return component_of(rows, "doc_id", 2).select("doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


QUERIES = {"op9_simhash": _query}
