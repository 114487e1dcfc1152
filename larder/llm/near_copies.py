"""Near copies by exact resemblance: texts whose sets of five-word shingles share four fifths of all of them.

Shingles stand in one order common to all texts, those frequent in a sample last.  Two sets of that resemblance have one
of the first fifth and one more of their shingles, their prefix, in common; so candidates share a prefix shingle,
whatever the number of texts.  Most shingles are in one text only: blocks of texts send their prefixes to shards, packed,
and get back one bit for each, whether another set has it.  Only the others become rows.

In every round all nodes (distinct sets) of a prefix shingle are compared with a few leaders, and pairs that are joined
already are left out. A set is also a few bits for each of its shingles; bits of one side alone count shingles that the other
lacks, which rules out nearly all pairs that share no more than a passage, and no pair that is alike.  Of the others, a
member's set goes to its leader, whose own is read once.  Rounds end when no shingle has nodes of two
components.  Written tables of a round go when the next stands, and with them the shuffles that made them.  Sets are
written in buckets by node, so that no round moves them all.

With a ``radius`` the SimHash operator comes first: texts whose fingerprints its bit planes link are joined, and the exact
comparison follows for all that is still apart.

Words are compared without case of A to Z and without punctuation at their ends; texts of fewer than five words have one
shingle, texts without a word are copies of each other.  Shingles are compared as 64-bit hashes, their sets as 128 bits, and
nodes are places in a written table, so no two sets are one by chance of their number.  Null keys come first; ties of a
key are told apart by a hash of the text, and rows alike in both share their fate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import session
from larder.llm import blocks
from larder.llm.common import by_bytes, drop_worker_cache, fit_rows, spans, text_array
from larder.llm.simhash import component_of, components, fingerprints
from larder.llm.substrings import run_hashes, span_hashes, word_spans

#: Near copies: distinct five-word shingles, of which the shared ones are at least LIKE[0] / LIKE[1] of all.
COPY_SHINGLE, LIKE = 5, (4, 5)
#: Frequent shingles are looked for in about so many texts; they are those that so many of these have.  They only set an
#: order that keeps buckets small: which pairs are found does not depend on them.
SAMPLE_TEXTS, FREQUENT, MOST_FREQUENT = 10_000, 6, 1 << 18
#: Prefix shingles in a shard, bytes that are sent of each, and bytes that are kept of each when sets are compared.
PER_SHARD, SENT_BYTES, KEPT_BYTES = 1 << 20, 5, 6
#: Bits of a node that count texts in a slice, and of a slice those that count slices of a task.
_PLACE, _SLICE = 23, 20
_SLICE_BYTES = 1 << 20
#: Bytes of text whose words and shingles a worker holds at a time; each takes some sixty times as much while it is hashed.
PART_BYTES = 1 << 17
#: Sets in a bucket of their table.
SETS_PER_BUCKET = 4_000
#: Words in a shingle of a fingerprint.
PRINT_SHINGLE = 3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_CORE = np.ones(256, bool)
_CORE[[0x20, *range(0x09, 0x0E), *b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"]] = False


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, in one array, and the offsets of the texts in it."""
    data, begins = blocks.joined_bytes(texts)
    data = _LOWER[data]
    starts, ends = word_spans(data)
    # a word runs from its first to its last byte that is no punctuation
    core = np.append(np.flatnonzero(_CORE[data]), len(data))
    first, after = np.searchsorted(core, starts), np.searchsorted(core, ends)
    some = first < after
    starts, ends = core[first[some]], core[after[some] - 1] + 1
    words = span_hashes(data, starts, ends)
    upto = np.append(np.searchsorted(starts, begins), len(starts))
    n_words = np.diff(upto)
    doc = np.repeat(np.arange(len(begins)), n_words)
    left = n_words[doc] - (np.arange(len(doc)) - upto[doc])
    at = np.flatnonzero(left >= COPY_SHINGLE)
    hashes, owner = [run_hashes(words, at, COPY_SHINGLE, 5)], [doc[at]]
    for n in range(1, COPY_SHINGLE):  # shorter texts are one shingle
        short = np.flatnonzero(n_words == n)
        hashes.append(run_hashes(words, upto[short], n, 5 + n))
        owner.append(short)
    flat, own = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((flat, own))
    flat, own = flat[order], own[order]
    new = np.append(True, (flat[1:] != flat[:-1]) | (own[1:] != own[:-1]))[: len(flat)]
    return flat[new], spans(np.bincount(own[new], minlength=len(begins)))


def _within(own: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(own), bool)
    return ascending[np.minimum(np.searchsorted(ascending, own), len(ascending) - 1)] == own


def prefixes(flat: np.ndarray, offsets: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each set, in the common order, its first fifth and one more; and their offsets."""
    num, den = LIKE
    sizes = np.diff(offsets)
    own = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((flat, _within(flat, frequent), own))
    wanted = np.where(sizes > 0, sizes + (-num * sizes // den) + 1, 0)
    taken = np.arange(len(flat)) - offsets[:-1][own] < wanted[own]
    return flat[order][taken], spans(wanted)


def frequent_shingles(df: DataFrame, text: str = "text") -> np.ndarray:
    """Shingles that many texts of a sample, taken by hash, have, ascending."""
    share = int(min(1.0, SAMPLE_TEXTS / max(df.count(), 1)) * (1 << 40))
    sample = df.filter(F.pmod(F.xxhash64(text, F.lit(5)), F.lit(1 << 40)) <= share).select(F.col(text).alias("__text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_cache()
        for batch in by_bytes(batches, 0, PART_BYTES):
            found, n = np.unique(shingle_sets(text_array(batch.column(0)))[0].view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["s", "n"])

    counts = sample.mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT)
    # at most MOST_FREQUENT hashes come to the driver
    most = counts.orderBy(F.desc("n"), "s").limit(MOST_FREQUENT).agg(F.collect_list("s").alias("all")).first()["all"]
    return np.sort(np.array(most, np.int64).view(np.uint64))


def _slices(frequent: np.ndarray, printed: bool):
    """A row for each slice of (key, tie, text): its keys, ties, 128 bits and sizes of sets, fingerprints if asked for, and prefixes."""

    def of_part(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, bytes]:
        from xxhash import xxh3_128_digest

        flat, offsets = shingle_sets(texts)
        prints = fingerprints(texts, PRINT_SHINGLE).view(np.int64) if printed else np.zeros(len(texts), np.int64)
        head, cuts = prefixes(flat, offsets, frequent)
        values = [xxh3_128_digest(flat[a:b].astype("<u8").tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return values, prints, np.diff(offsets), np.diff(cuts), head.astype("<u8").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_cache()
        first = TaskContext.get().partitionId() << _SLICE
        for number, batch in enumerate(by_bytes(batches, 2, _SLICE_BYTES)):
            parts = [of_part(text_array(part.column(2))) for part in by_bytes(iter([batch]), 2, PART_BYTES)]
            values, prints, sizes, heads, head = zip(*parts, strict=True)
            whole = pa.array([0, len(batch)], pa.int32())
            columns = batch.column(0), batch.column(1), pa.array([v for own in values for v in own], pa.binary()), *(pa.array(np.concatenate(c)) for c in (prints, sizes, heads))
            lists = [pa.ListArray.from_arrays(whole, c) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array([first + number]), *lists, pa.array([b"".join(head)], pa.binary())], names=_SLICE_COLUMNS)
            pa.default_memory_pool().release_unused()

    return run


_SLICE_COLUMNS = ["block", "keys", "ties", "sets", "prints", "sizes", "heads", "prefix"]


def _sets_by_slice(own: DataFrame, frequent: np.ndarray, printed: bool) -> DataFrame:
    kinds = T.LongType(), *map(T.ArrayType, (own.schema["key"].dataType, T.LongType(), T.BinaryType(), *[T.LongType()] * 3)), T.BinaryType()
    schema = T.StructType([T.StructField(*field) for field in zip(_SLICE_COLUMNS, kinds, strict=True)])
    return session.materialise(own.mapInArrow(_slices(frequent, printed), schema), "set-slices")


def _of_nodes(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each slice: its name, the places of its nodes, their sizes, the prefixes of its nodes and whose they are."""
    for row, name in enumerate(batch.column("block").to_pylist()):
        places = np.sort(np.array(batch.column("places")[row].as_py() or [], np.int64))
        heads = np.array(batch.column("heads")[row].as_py(), np.int64)
        sizes = np.array(batch.column("sizes")[row].as_py(), np.int64)
        flat, owner = np.frombuffer(batch.column("prefix")[row].as_py(), "<u8"), np.repeat(np.arange(len(heads)), heads)
        chosen = np.isin(owner, places)
        yield name, places, sizes, flat[chosen], owner[chosen]


_SENT_SQL, _ANSWER_SQL = "shard int, block long, low binary, several binary", "block long, shard int, answer binary"
_SENT = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("low", pa.binary()), ("several", pa.binary())])
_ANSWER = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("answer", pa.binary())])


def _send(shards: int):
    """The distinct prefix shingles of a slice, for each shard its own, and which of them two of the slice's nodes have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, _, _, flat, _ in _of_nodes(batch):
                hashes, counts = np.unique(flat, return_counts=True)
                cuts = blocks.cuts_of(hashes, shards)
                full = np.flatnonzero(np.diff(cuts))
                low, several = blocks.narrow(hashes, shards, SENT_BYTES), counts > 1
                pieces = [(low[cuts[s] : cuts[s + 1]].tobytes(), np.packbits(several[cuts[s] : cuts[s + 1]]).tobytes()) for s in full]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([name] * len(full), pa.int64()), pa.array([p[0] for p in pieces], pa.binary()), pa.array([p[1] for p in pieces], pa.binary())], schema=_SENT)

    return run


def _shared(rows: pa.Table) -> pa.Table:
    """Of one shard: which shingles two slices have, or two nodes of one slice."""
    low = rows["low"].to_pylist()
    bounds = spans(np.fromiter((len(x) // SENT_BYTES for x in low), np.int64, len(low)))
    hashes = blocks.widened(low, SENT_BYTES)
    here = np.concatenate([blocks.flags_of(p, int(n)) for p, n in zip(rows["several"].to_pylist(), np.diff(bounds), strict=True)])
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    here[order] |= np.append(same, False) | np.append(False, same)
    answer = [np.packbits(here[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.Table.from_arrays([rows["block"].combine_chunks(), rows["shard"].combine_chunks(), pa.array(answer, pa.binary())], schema=_ANSWER)


def _meetings(shards: int):
    """(bucket, node, size): the prefix shingles of nodes that another node has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (name, _, sizes, flat, owner) in enumerate(_of_nodes(batch)):
                hashes, entry = np.unique(flat, return_inverse=True)
                counts = np.diff(blocks.cuts_of(hashes, shards))
                packed = batch.column("shared")[row].as_py() or []
                bits = np.concatenate([np.zeros(0, bool), *(blocks.flags_of(p, int(n)) for p, n in zip(packed, counts[counts > 0], strict=True))])
                met = bits[entry]
                yield pa.RecordBatch.from_arrays([pa.array(flat[met].view(np.int64)), pa.array((name << _PLACE) + owner[met]), pa.array(sizes[owner[met]])], names=["bucket", "node", "size"])

    return run


def bit_sets(flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Of each set, bits at the upper bits of its hashes; two to four times as many bits as hashes, 256 at least."""
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        width = max(8, (2 * (b - a) - 1).bit_length()) if b > a else 8
        bits = np.zeros(1 << width, np.uint8)
        bits[(flat[a:b] >> np.uint64(64 - width)).astype(np.int64)] = 1
        out.append(np.packbits(bits).tobytes())
    return out


def _as_narrow(one: bytes, size: int) -> int:
    """Bits as a number, neighbours joined until there are ``size`` bytes."""
    bits = np.unpackbits(np.frombuffer(one, np.uint8))
    while len(bits) > 8 * size:
        bits = bits.reshape(-1, 2).max(axis=1)
    return int.from_bytes(np.packbits(bits).tobytes())


def may_be_alike(one: bytes, two: bytes, n: int, m: int) -> bool:
    """False only if sets of ``n`` and ``m`` shingles cannot share enough: every bit of one side alone is a shingle of it alone."""
    num, den = LIKE
    size = min(len(one), len(two))
    a, b = (int.from_bytes(x) if len(x) == size else _as_narrow(x, size) for x in (one, two))
    need = -(-num * (n + m) // (num + den))
    return (a & ~b).bit_count() <= n - need and (b & ~a).bit_count() <= m - need


def _with_sets(df: DataFrame) -> DataFrame:
    """(node, n, bits, set): the distinct shingles of a text, as ascending numbers of KEPT_BYTES bytes and as bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, PART_BYTES):
            flat, offsets = shingle_sets(text_array(batch.column(1)))
            kept = blocks.narrow(flat, 1, KEPT_BYTES)
            sets = pa.array([kept[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(bit_sets(flat, offsets), pa.binary()), sets], names=["node", "n", "bits", "set"])

    return df.select("node", "text").mapInArrow(run, "node long, n long, bits binary, set binary")


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (u, v) that their bits leave over."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bits_u", "bits_v", "n_u", "n_v")]
        mask = pa.array([may_be_alike(*pair) for pair in zip(*columns, strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("u", "v")], names=["u", "v"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (u, v) whose sets share enough."""
    num, den = LIKE
    for batch in batches:
        kept = []
        # sets are read where they lie in the batch: a leader's comes once for each of its members
        for one, two in zip(batch.column("of_u"), batch.column("of_v"), strict=True):
            a, b = blocks.widened([one.as_buffer()], KEPT_BYTES), blocks.widened([two.as_buffer()], KEPT_BYTES)
            common = int(_within(a, b).sum())
            kept.append((num + den) * common >= num * (len(a) + len(b)))
        mask = pa.array(kept, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("u", "v")], names=["u", "v"])


def _with_components(met: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``met`` in buckets that still have more than one component."""
    named = met.drop("comp").join(found, "node", "left").select("bucket", "node", "size", F.coalesce("root", "node").alias("comp"))
    return session.materialise(_several(named), "met")


def _by_fingerprints(rows: DataFrame, nodes: DataFrame, radius: int) -> DataFrame:
    """(node, root): nodes whose texts the SimHash operator links."""
    prints = rows.join(nodes.select("value", F.col("node").alias("own")), "value").select(F.col("own").alias("node"), "print").distinct()
    linked = component_of(session.materialise(prints, "prints"), "node", radius, "print")
    return session.materialise(components(linked.select(F.col("node").alias("u"), F.col("component_id").alias("v"))), "copies")


def resembling(met: DataFrame, sets: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches over pairs of resemblance 0.8 or more, and what is found already.

    ``met`` has (bucket, node, size), a row for each bucket of a node; ``sets`` has (node, n, bits, set).  A round takes four times as
    many leaders as the one before, which leave their buckets afterwards.
    """
    num, den = LIKE
    found = found or met.sparkSession.createDataFrame([], "node long, root long")
    left = _with_components(met, found)
    wanted = 1
    while left.first():
        salt = F.pmod(F.xxhash64("node", F.lit(wanted)), F.lit(wanted))
        leaders = left.groupBy("bucket", salt.alias("salt")).agg(F.min(F.struct("node", "size", "comp")).alias("l"))
        leaders = session.materialise(leaders.select(F.col("bucket").alias("at"), F.col("l.node").alias("leader"), F.col("l.size").alias("n"), F.col("l.comp").alias("c")), "leaders")
        apart = left.join(leaders, F.col("bucket") == F.col("at")).filter("comp != c")
        apart = apart.filter(den * F.least("size", "n") >= num * F.greatest("size", "n"))
        pairs = apart.select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct()
        # most pairs share a passage and no more, which the bits of their sets tell; only the others move sets
        for side in ("v", "u"):
            pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)
        pairs = session.materialise(pairs.select("u", "v", "n_u", "n_v", "bits_u", "bits_v").mapInArrow(_possible, "u long, v long"), "pairs")
        # a member's set goes to its leader; a leader's own is read once, however many members it has
        members = pairs.join(sets.select(F.col("node").alias("v"), F.col("set").alias("of_v")), "v")
        heads = sets.join(pairs.select(F.col("u").alias("node")).distinct(), "node", "left_semi")
        both = members.join(heads.select(F.col("node").alias("u"), F.col("set").alias("of_u")), "u")
        new = session.materialise(both.select("u", "v", "of_u", "of_v").mapInArrow(_alike, "u long, v long"), "copies")
        older = [left, leaders]
        if new.first():
            # what is joined already is a star around its root
            edges = found.select(F.col("node").alias("u"), F.col("root").alias("v")).union(new)
            older.append(found)
            found = session.materialise(components(edges), "copies")
        rest = left.join(leaders, (F.col("bucket") == F.col("at")) & (F.col("node") == F.col("leader")), "left_anti")
        left = _with_components(rest, found)
        for frame in [*older, pairs, new]:
            session.discard(frame)
        del apart, pairs, members, heads, both, rest, older, leaders, new
        session.release(left.sparkSession)
        wanted *= 4
    return found


def _several(rows: DataFrame) -> DataFrame:
    """The rows of buckets that have more than one component."""
    several = rows.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("bucket")
    return rows.join(several, "bucket", "left_semi")


def _one_text(own: DataFrame, rows: DataFrame, meeting: DataFrame) -> DataFrame:
    """(key, tie, text, node, ...): of each node (node, k, t) one of the rows that have its key and tie.

    Only rows that are repeated are gathered to take one; all others are moved no more than to meet their node.
    """
    repeated = rows.groupBy(F.col("key").alias("rk"), F.col("tie").alias("rt")).agg(F.count("*").alias("n")).filter("n > 1")
    marked = meeting.join(repeated, F.col("k").eqNullSafe(F.col("rk")) & (F.col("t") == F.col("rt")), "left").select("node", "k", "t", F.col("n").isNotNull().alias("again"))
    marked = session.materialise(marked, "meeting")
    chosen = own.join(marked, F.col("key").eqNullSafe(F.col("k")) & (F.col("tie") == F.col("t")))
    return chosen.filter(~F.col("again")).union(chosen.filter("again").dropDuplicates(["node"]))


def near_copies(df: DataFrame, key: str, text: str = "text", radius: int | None = None) -> DataFrame:
    """(key, tie, component_id, rank): components of texts linked where their five-word resemblance is 0.8 or more.

    Every such pair is found, at any number of rows, and no other pair is a link, but for those that the SimHash operator
    links where a ``radius`` is given.  ``tie`` is a hash of the text;
    ``component_id`` is the first (key, tie) of the component, and ``rank`` is 1 for the texts that have it, and null else.
    """
    tie = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    own = df.select(F.col(key).alias("key"), tie.alias("tie"), F.col(text).alias("text"))
    table = _sets_by_slice(own, frequent_shingles(own), radius is not None)
    each = F.posexplode(F.arrays_zip("keys", "ties", "sets", "prints")).alias("place", "r")
    rows = table.select("block", each).select(F.shiftleft("block", _PLACE).bitwiseOR(F.col("place").cast("long")).alias("node"), F.col("r.keys").alias("key"), F.col("r.ties").alias("tie"), F.col("r.sets").alias("value"), F.col("r.prints").alias("print"))
    rows = session.materialise(rows, "set-rows")
    nodes = rows.groupBy("value").agg(F.min(F.struct("key", "tie")).alias("least"), F.min("node").alias("node"))
    nodes = session.materialise(nodes, "nodes")
    places = nodes.groupBy(F.shiftright("node", _PLACE).alias("block")).agg(F.collect_list(F.col("node").bitwiseAND(F.lit((1 << _PLACE) - 1))).alias("places"))
    asked = table.select("block", "sizes", "heads", "prefix").join(places, "block")
    n = table.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    shards = blocks.shards_for(n // 8, PER_SHARD)
    answered = asked.mapInArrow(_send(shards), _SENT_SQL).groupBy("shard").applyInArrow(_shared, _ANSWER_SQL)
    met = asked.join(blocks.answers(answered, "shared"), "block").mapInArrow(_meetings(shards), "bucket long, node long, size long")
    met = session.materialise(met, "met")
    session.discard(table)
    del answered, asked, places, table
    session.release(df.sparkSession)
    linked = None
    if radius is not None:
        linked = _by_fingerprints(rows, nodes, radius)
        every, met = met, _with_components(met, linked)
        session.discard(every)
        session.release(df.sparkSession)
    # sets are made again for the nodes that meet another, from one of their texts
    meeting = nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", F.col("least.key").alias("k"), F.col("least.tie").alias("t"))
    chosen = _one_text(own, rows, meeting)
    buckets = fit_rows(nodes.count(), SETS_PER_BUCKET, 8)
    sets = session.bucketed(_with_sets(chosen), "sets", "node", buckets)
    del chosen, meeting
    session.release(df.sparkSession)
    found = resembling(met, sets, linked)
    session.discard(met)
    session.discard(sets)
    rooted = nodes.join(found.withColumnRenamed("node", "__node"), F.col("node") == F.col("__node"), "left")
    rooted = rooted.select("value", "least", F.coalesce("root", "node").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_value = rooted.join(names, "root").select("value", "component_id")
    named = rows.select("key", "tie", "value").join(by_value, "value")
    is_first = F.struct("key", "tie").eqNullSafe(F.col("component_id"))
    return named.select("key", "tie", F.col("component_id.key").alias("component_id"), F.when(is_first, 1).alias("rank"))
