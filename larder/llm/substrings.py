"""Substring dedup by difference-cover anchors.

Two places i and j of any two texts have, for some d below the period, i + d and j + d both in the cover modulo the
period.  So a match of ``length`` words has, at one of its first ``period`` places, an anchor (a shorter run of words that
starts at a cover position) in both texts.  Only anchors are hashed and asked about: 3 of 7 positions.  Where an anchor
is shared, it is extended: the windows around it, and no others, are hashed whole and compared over the corpus.

1. Documents are written as blocks; a block sends its distinct anchors to shards by hash, 5 bytes each, and
   gets back one bit for each: whether another document has it.
2. Windows with a shared anchor are sent likewise, with the least key that has them in the block; the shard answers whether
   a smaller key has the window.  The 72 bits sent and the shard's own make up the comparison, 78 bits or more, growing with
   the corpus.
3. The block removes the words of all windows that a document of a smaller key has.

Hashing and extending run over arrays of a block's bytes in the worker; Spark shuffles, groups and joins.  An anchor or a
window is sent once a block however often it occurs, so text common to a third of all rows weighs as little as any other.

Null and empty texts have no words.  Null keys are larger than any key.  Rows of equal keys never remove each other's
words; repeated rows stay repeated.  Texts of fewer words than a window keep them all.  Other columns are not returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import session
from larder.llm import blocks
from larder.llm.chunks import gather
from larder.llm.common import documents, mixed, spans

#: Every difference modulo the period is one of two cover positions.
PERIOD, COVER = 7, (0, 1, 3)
#: Bytes hashed at a time; some ten arrays of as many 64-bit words are held meanwhile, and four tables of powers for good.
SEGMENT = 1 << 18
#: Bytes of text in a block: a worker holds some thirty times as many while it works on one.
BLOCK_BYTES = 2 << 20
#: Anchors and windows in a shard.
PER_SHARD = 1 << 20
_LOW, _HIGH = 5, 4

_PRIME = (1 << 31) - 1
_BASE = (0x9E3779B97F4A7C15, 1_103_515_245)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, n: int, modulus: int) -> np.ndarray:
    """base^0 ... base^(n - 1), by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = pow(base, len(out), modulus)
        more = out * np.uint64(step)
        out = np.concatenate([out, more if modulus == 1 << 64 else more % np.uint64(modulus)])
    return out[:n]


class _Powers:
    """Powers of both bases and of their inverses, as far as a segment needs them."""

    def __init__(self) -> None:
        self.n = 0

    def upto(self, n: int) -> list[np.ndarray]:
        if n > self.n:
            self.n = max(n, SEGMENT)
            self.tables = [
                _powers(base, self.n, modulus)
                for b, modulus in zip(_BASE, (1 << 64, _PRIME), strict=True)
                for base in (b, pow(b, -1, modulus))
            ]
        return self.tables


_POWERS = _Powers()


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the words of some bytes: runs without space and U+0009 to U+000D."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _WHITE[data], [True]])))
    return edges[::2], edges[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ascending spans of bytes that do not meet.

    Two polynomials, modulo 2^64 and a prime, are differences of prefix sums, so the cost is that of a few array
    operations over the bytes.  Segments end between spans; a span longer than a segment is hashed by itself.
    """
    from xxhash import xxh64_intdigest

    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        upto = int(np.searchsorted(ends, starts[at] + SEGMENT, "right"))
        a, b = starts[at], ends[max(at, upto - 1)]
        if upto <= at:
            out[at] = xxh64_intdigest(data[a:b].tobytes())
            at += 1
            continue
        powers, back, field, field_back = _POWERS.upto(int(b - a) + 1)
        own = data[a:b].astype(np.uint64) + np.uint64(1)
        ring = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * powers[: len(own)], dtype=np.uint64)])
        prime = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * field[: len(own)] % np.uint64(_PRIME), dtype=np.uint64)])
        s, e = starts[at:upto] - a, ends[at:upto] - a
        one = (ring[e] - ring[s]) * back[s]
        two = (prime[e] - prime[s]) % np.uint64(_PRIME) * field_back[s] % np.uint64(_PRIME)
        out[at:upto] = mixed(mixed(one) ^ (two << np.uint64(32)) ^ (e - s).astype(np.uint64))
        at = upto
    return out


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of the words of some bytes."""
    starts, ends = word_spans(data)
    return span_hashes(data, starts, ends), starts, ends


def run_hashes(words: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hashes of the runs of ``length`` word hashes that start at some places."""
    factors = mixed(np.arange(1, length + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)
    total = np.zeros(len(at), np.uint64)
    for k in range(length):
        total += words[at + k] * factors[k]
    return mixed(total)


@dataclass
class _Distinct:
    """Distinct hashes, ascending; the entry of each occurrence; least and largest key of each entry."""

    hashes: np.ndarray
    more: np.ndarray
    entry: np.ndarray
    least: np.ndarray
    largest: np.ndarray


def _distinct(hashes: np.ndarray, more: np.ndarray, keys: np.ndarray) -> _Distinct:
    order = np.lexsort((more, hashes)) if len(more) else np.argsort(hashes, kind="stable")
    one, two = hashes[order], more[order] if len(more) else more
    new = np.ones(len(one), bool)
    new[1:] = one[1:] != one[:-1]
    if len(two):
        new[1:] |= two[1:] != two[:-1]
    first = np.flatnonzero(new)
    entry = np.empty(len(one), np.int64)
    entry[order] = np.cumsum(new) - 1
    if not len(one):
        return _Distinct(one, two, entry, keys[:0], keys[:0])
    return _Distinct(one[first], two[first] if len(two) else two, entry, np.minimum.reduceat(keys[order], first), np.maximum.reduceat(keys[order], first))


class _Block:
    """The words of one block, its anchors, and the windows around shared ones."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, length: int):
        self.data, begins = blocks.joined_bytes(texts)
        self.ids, self.length = ids, length
        self.words, self.starts, self.ends = word_hashes(self.data)
        #: the words of document d are those from first[d] to first[d + 1]
        self.first = np.append(np.searchsorted(self.starts, begins), len(self.starts))
        self.n_words = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(ids), dtype=np.int32), self.n_words)
        place = np.arange(len(self.doc)) - self.first[self.doc]
        left = self.n_words[self.doc] - place
        anchor = length - PERIOD + 1
        self.anchors = np.flatnonzero(np.isin(place % PERIOD, COVER) & (left >= anchor))
        self.fits = left >= length
        del place, left
        self.anchor = _distinct(run_hashes(self.words, self.anchors, anchor, 1), np.zeros(0, np.uint64), ids[self.doc[self.anchors]])

    def extend(self, shared: np.ndarray) -> None:
        """The windows that hold one of the shared anchors at one of their first places."""
        has = np.zeros(len(self.doc) + PERIOD, np.int64)
        has[self.anchors[shared[self.anchor.entry]]] = 1
        upto = spans(has)
        del has
        near = upto[PERIOD : PERIOD + len(self.doc)] > upto[: len(self.doc)]
        self.windows = np.flatnonzero(near & self.fits)
        hashes = run_hashes(self.words, self.windows, self.length, 2)
        more = run_hashes(mixed(self.words), self.windows, self.length, 3) >> np.uint64(32)
        self.window = _distinct(hashes, more, self.ids[self.doc[self.windows]])

    def removed(self, earlier: np.ndarray) -> np.ndarray:
        """The words covered by windows that a smaller key has, here or, by ``earlier``, elsewhere."""
        entry = self.window.entry
        gone = self.windows[earlier[entry] | (self.ids[self.doc[self.windows]] > self.window.least[entry])]
        change = np.zeros(len(self.doc) + 1, np.int64)
        change[gone] += 1
        change[gone + self.length] -= 1
        return np.cumsum(change[:-1]) > 0

    def counted(self, removed: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """The words of each text, and how many of them are removed."""
        upto = spans(removed)
        return pa.array(self.n_words), pa.array(upto[self.first[1:]] - upto[self.first[:-1]])

    def kept_texts(self, removed: np.ndarray) -> pa.Array:
        """The kept words joined by one space."""
        kept = np.flatnonzero(~removed)
        lengths = self.ends[kept] - self.starts[kept] + 1
        out = self.data[np.minimum(gather(self.starts[kept], lengths), len(self.data) - 1)]
        ends = np.cumsum(lengths)
        out[ends - 1] = 0x20
        # a text ends one byte before the next begins
        offsets = spans(lengths)[np.searchsorted(kept, self.first)]
        texts = [out[a : max(a, b - 1)].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return pa.array(texts, pa.binary()).cast(pa.string())


def _sent(block: int, found: _Distinct, shards: int, whole: bool) -> pa.RecordBatch:
    """A row for each shard: what of the hashes a shard needs; windows (``whole``) with more bits and their least keys."""
    cuts = blocks.cuts_of(found.hashes, shards)
    full = np.flatnonzero(np.diff(cuts))
    low = blocks.narrow(found.hashes, shards, _LOW)
    high = blocks.narrow(found.more << np.uint64(32), 1, _HIGH) if whole else None
    several = found.least != found.largest
    rows = {"shard": pa.array(full, pa.int32()), "block": pa.array([block] * len(full), pa.int64()), "low": [], "high": [], "several": [], "least": []}
    for s in full:
        a, b = cuts[s], cuts[s + 1]
        rows["low"].append(low[a:b].tobytes())
        rows["high"].append(high[a:b].tobytes() if whole else b"")
        rows["several"].append(b"" if whole else np.packbits(several[a:b]).tobytes())
        rows["least"].append(found.least[a:b].astype("<i8").tobytes() if whole else b"")
    return pa.RecordBatch.from_pydict(rows, schema=_SENT)


_SENT = pa.schema([("shard", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in ("low", "high", "several", "least"))])
_SENT_SQL = "shard int, block long, low binary, high binary, several binary, least binary"
_ANSWER = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("answer", pa.binary())])
_ANSWER_SQL = "block long, shard int, answer binary"


def _answered(rows: pa.Table, flags: np.ndarray, bounds: np.ndarray) -> pa.Table:
    pa.default_memory_pool().release_unused()
    answer = [np.packbits(flags[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.Table.from_arrays([rows["block"].combine_chunks(), rows["shard"].combine_chunks(), pa.array(answer, pa.binary())], schema=_ANSWER)


def _shared_anchors(rows: pa.Table) -> pa.Table:
    """Of one shard: the anchors that two documents have, of one block or of two."""
    low = rows["low"].to_pylist()
    bounds = spans(np.fromiter((len(x) // _LOW for x in low), np.int64, len(low)))
    hashes = blocks.widened(low, _LOW)
    here = np.concatenate([blocks.flags_of(p, int(n)) for p, n in zip(rows["several"].to_pylist(), np.diff(bounds), strict=True)])
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    shared = np.zeros(len(hashes), bool)
    shared[order] = np.append(same, False) | np.append(False, same)
    return _answered(rows, shared | here, bounds)


def _earlier_windows(rows: pa.Table) -> pa.Table:
    """Of one shard: the windows whose least key in the block is above that of another block."""
    low = rows["low"].to_pylist()
    bounds = spans(np.fromiter((len(x) // _LOW for x in low), np.int64, len(low)))
    hashes, high = blocks.widened(low, _LOW), blocks.widened(rows["high"].to_pylist(), _HIGH)
    least = np.frombuffer(b"".join(rows["least"].to_pylist()), "<i8")
    # the high bits fill what the low ones leave of a word, and more
    found = _distinct(hashes << np.uint64(24) | high >> np.uint64(8), high & np.uint64(255), least)
    return _answered(rows, least > found.least[found.entry], bounds)


def _each_block(batches: Iterator[pa.RecordBatch], length: int, use: Callable[[pa.RecordBatch, int, int, _Block], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``use`` makes of each block, in slices; a block is gone before its rows are sent and the next one is made."""
    for batch in batches:
        for row, name in enumerate(batch.column("block").to_pylist()):
            yield from _sliced(use(batch, row, name, _Block(blocks.ids_of(batch.column("ids"), row), batch.column("texts")[row].values, length)))
            pa.default_memory_pool().release_unused()


def _flags(batch: pa.RecordBatch, column: str, row: int, found: _Distinct, shards: int) -> np.ndarray:
    """The answers of all shards to the distinct hashes of a block."""
    sizes = np.diff(blocks.cuts_of(found.hashes, shards))
    packed = batch.column(column)[row].as_py() or []
    return np.concatenate([np.zeros(0, bool), *(blocks.flags_of(p, int(n)) for p, n in zip(packed, sizes[sizes > 0], strict=True))])


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, n_words, n_removed, kept): each text without the words of windows that a smaller key has too.

    A window is ``length`` (8 or more) consecutive words; windows are judged on the texts as given.
    """
    if length <= PERIOD:
        raise ValueError(f"windows are longer than {PERIOD} words")
    table = blocks.written(df, key, text, "substrings", block_bytes)
    size = table.agg(F.sum(F.aggregate("texts", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t)))).first()[0] or 0
    # a word of natural text takes some six bytes with its space
    shards = blocks.shards_for(size * len(COVER) // (6 * PERIOD), PER_SHARD)

    def anchors(batch: pa.RecordBatch, row: int, name: int, block: _Block) -> pa.RecordBatch:
        return _sent(name, block.anchor, shards, False)

    shared = table.mapInArrow(lambda batches: _each_block(batches, length, anchors), _SENT_SQL).groupBy("shard").applyInArrow(_shared_anchors, _ANSWER_SQL)
    shared = session.materialise(blocks.answers(shared, "shared"), "shared-anchors")
    asked = table.join(shared, "block", "left")

    def windows(batch: pa.RecordBatch, row: int, name: int, block: _Block) -> pa.RecordBatch:
        block.extend(_flags(batch, "shared", row, block.anchor, shards))
        return _sent(name, block.window, shards, True)

    earlier = asked.mapInArrow(lambda batches: _each_block(batches, length, windows), _SENT_SQL).groupBy("shard").applyInArrow(_earlier_windows, _ANSWER_SQL)
    # one plan for both uses of the blocks joined with their anchors, so that texts are shuffled once
    judged = asked.join(blocks.answers(earlier, "earlier"), "block", "left")

    def results(batch: pa.RecordBatch, row: int, name: int, block: _Block) -> pa.RecordBatch:
        block.extend(_flags(batch, "shared", row, block.anchor, shards))
        removed = block.removed(_flags(batch, "earlier", row, block.window, shards))
        columns = [batch.column("ids")[row].values, *block.counted(removed), block.kept_texts(removed)]
        return pa.RecordBatch.from_arrays(columns, names=[key, "n_words", "n_removed", "kept"])

    return judged.mapInArrow(lambda batches: _each_block(batches, length, results), f"`{key}` long, n_words long, n_removed long, kept string")


def _sliced(batch: pa.RecordBatch, rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


QUERIES = {"op13_substrings": _query}

SQL = {
    "op13_substrings": """
        with words as (
            select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents
        ), windows as (
            select doc_id, i, array_to_string(w[i:i + 12], ' ') as run from words, unnest(range(1, len(w) - 11)) as u(i)
        ), firsts as (
            select run, min(doc_id) as first from windows group by run
        ), gone as (
            select distinct doc_id, i + k as place from windows join firsts using (run), unnest(range(0, 13)) as v(k) where first < doc_id
        ), kept as (
            select doc_id, place, w[place] as word, gone.place is not null as removed
            from (select doc_id, w, unnest(range(1, len(w) + 1)) as place from words) left join gone using (doc_id, place)
        ), texts as (
            select doc_id, count(*) filter (removed) as n_removed, string_agg(word, ' ' order by place) filter (not removed) as text from kept group by doc_id
        )
        select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256
        from words left join texts using (doc_id)
    """,
}
