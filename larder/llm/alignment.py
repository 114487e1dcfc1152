"""Cross-tokenizer alignment, with corpus-wide counts of linked token pairs behind a minimal perfect hash.

Two tokenizers cut the same bytes.  Offsets where tokens of both end cut them into groups; two tokens are linked where
their bytes overlap.  How often an id pair is linked in the whole corpus tells which links are usual.

1. Documents are written as blocks.  Each block aligns its texts and sends its distinct id pairs, with how often they are
   linked, to shards by the second id.
2. The distinct pairs of a shard get a minimal perfect hash: levels of bits, in each of which the pairs that fall on a place
   of their own leave.  A pair's rank is its slot; the pairs stand beside it in the order of slots and verify each look-up.
3. Groups of blocks count into dense vectors indexed by slot, which are summed in a tree of fixed width.
4. Each block's pairs look up their counts; the block aligns its texts again and sums them by document.

Pairs are at most the product of the vocabularies, so shards and vectors are bounded however large the corpus is, and no
table of pairs is broadcast.  Both tokenizers end a token before a space that follows a character other than white space,
so a block aligns each distinct chunk between such places once, and each pass aligns anew.

Null and empty texts, and texts that one of the tokenizers does not give back byte by byte, have no tokens: zeros and
empty groups.  Null keys stay null; repeated rows stay repeated and count as often.  Other columns are not returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import session
from larder.llm import blocks, chunks, pieces, tokenizers_
from larder.llm.chunks import gather
from larder.llm.common import documents, mixed, spans, worker_cache

#: Pairs sent by all blocks to one shard; shards end at what the vocabularies can fill.
PER_SHARD, MOST_SHARDS = 1 << 24, 4096
#: Blocks that count into one vector, and vectors that are summed at a time.
WIDTH = 64


# -- minimal perfect hash ---------------------------------------------------------------------------------------------


class PerfectHash:
    """Distinct 64-bit keys to 0 ... n - 1.  A key that was not among them gets any slot, or -1."""

    def __init__(self, sizes: list[int], bits: list[bytes]):
        self.sizes = sizes
        self.bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=m) for m, b in zip(sizes, bits, strict=True)]
        ones = spans(np.array([int(b.sum()) for b in self.bits], np.int64))
        self.ranks = [np.cumsum(b) - 1 + first for b, first in zip(self.bits, ones[:-1], strict=True)]
        self.n = int(ones[-1])

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], keys.astype(np.uint64)
        while len(left):
            size = max(64, 2 * len(left))
            places = cls._places(left, len(sizes), size)
            alone = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone).tobytes())
            left = left[~alone[places]]
        return cls(sizes, bits)

    def packed(self) -> list[bytes]:
        return [np.packbits(b).tobytes() for b in self.bits]

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        keys = keys.astype(np.uint64)
        for level, size in enumerate(self.sizes):
            places = self._places(keys[left], level, size)
            hit = self.bits[level][places].astype(bool)
            out[left[hit]] = self.ranks[level][places[hit]]
            left = left[~hit]
        return out


# -- alignment in a worker --------------------------------------------------------------------------------------------


def _piece_token(piece: str) -> bytes:
    code = re.fullmatch("<0x([0-9A-F]{2})>", piece)
    return bytes([int(code[1], 16)]) if code else piece.replace("▁", " ").encode()


class Aligner:
    """A byte-level vocabulary and a SentencePiece model side by side."""

    def __init__(self, byte_vocabulary: str, piece_model: str):
        self.encoders = tokenizers_.byte_level(byte_vocabulary).encode, pieces.model_at(piece_model).table.encode
        names = [tokenizers_.entries(byte_vocabulary), pieces.model_at(piece_model).pieces]
        self.tokens = [[tokenizers_.byte_token(x) for x in names[0]], [_piece_token(x) for x in names[1]]]
        self.sizes = [np.fromiter(map(len, own), np.int64, len(own)) for own in self.tokens]
        self.n_pieces = len(self.tokens[1])


def aligner(byte_vocabulary: str, piece_model: str) -> Aligner:
    return worker_cache(f"aligner {byte_vocabulary} {piece_model}", lambda: Aligner(byte_vocabulary, piece_model))


#: Bytes of text in a block, which is aligned as a whole, and distinct chunks that are encoded at a time.
BLOCK_BYTES = 2 << 20
_AT_ONCE = 20_000


class _Aligned:
    """Distinct chunks, each beginning with a space, aligned one after the other.

    The bytes of the chunks that come back byte by byte are one stream, which both sides cut.
    """

    def __init__(self, texts: list[str], tool: Aligner):
        made = [self._encoded(texts[a : a + _AT_ONCE], tool) for a in range(0, max(1, len(texts)), _AT_ONCE)]
        self.valid, sizes = (np.concatenate([m[k] for m in made]) for k in (0, 1))
        own = [tuple(np.concatenate([m[2 + side][k] for m in made]) for k in (0, 1)) for side in (0, 1)]
        self.ids = [ids[np.repeat(self.valid, counts)] for ids, counts in own]
        self.ends = [np.cumsum(sizes[ids]) for ids, sizes in zip(self.ids, tool.sizes, strict=True)]
        self.upto = np.cumsum(sizes * self.valid)
        # which side ends a token after each byte of the stream
        mark = np.zeros(int(self.upto[-1]) + 1 if len(self.upto) else 1, np.uint8)
        mark[self.ends[0]] = 1
        mark[self.ends[1]] |= 2
        links = np.flatnonzero(mark)
        here = mark[links]
        self.cuts = links[here == 3]
        # an overlap ends where either token does: the tokens there are the first not to end before
        at = [np.cumsum(here & side > 0) - (here & side > 0) for side in (1, 2)]
        self.pairs = self.ids[0][at[0]].astype(np.uint64) * np.uint64(tool.n_pieces) + self.ids[1][at[1]].astype(np.uint64)
        per_chunk = lambda e: np.diff(np.searchsorted(e, self.upto, "right"), prepend=0)
        #: tokens of either side, groups and links of each chunk
        self.numbers = np.stack([per_chunk(e) for e in (*self.ends, self.cuts, links)], axis=1)

    @staticmethod
    def _encoded(texts: list[str], tool: Aligner) -> tuple:
        """Which of some chunks come back, their sizes, and ids and numbers of ids of either side."""
        raw = [t.encode() for t in texts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        sides = [tool.encoders[0](texts), tool.encoders[1]([t[1:] for t in texts])]
        valid = np.ones(len(texts), bool)
        for (ids, counts), tokens in zip(sides, tool.tokens, strict=True):
            given = list(map(tokens.__getitem__, ids.tolist()))
            at = spans(np.fromiter(map(len, given), np.int64, len(given)))[spans(counts)]
            if b"".join(given) != b"".join(raw) or (np.diff(at) != sizes).any():
                upto = spans(counts).tolist()
                valid &= np.fromiter((b"".join(given[a:b]) == r for a, b, r in zip(upto[:-1], upto[1:], raw, strict=True)), bool, len(raw))
        return valid, sizes, *sides

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each chunk: after an id a comma, after the last of the first side a bar, after a group a semicolon."""
        group = [np.searchsorted(self.cuts, e) for e in self.ends]
        both, side = np.concatenate(group), np.repeat([0, 1], [len(g) for g in group])
        order = np.argsort(2 * both + side, kind="stable")
        run = (2 * both + side)[order]
        last = np.append(run[1:] != run[:-1], True)[: len(run)]
        ids = np.concatenate(self.ids)[order].astype(np.int64)
        # the digits of each id and what follows it, a row of bytes for each, of which leading zeros are left out
        width = 7
        rows = np.empty((len(ids), width + 1), np.uint8)
        for place in range(width):
            rows[:, width - 1 - place] = ids // 10**place % 10 + 0x30
        rows[:, width] = np.where(last, np.where(side[order] == 0, ord("|"), ord(";")), ord(","))
        digits = 1 + np.searchsorted(10 ** np.arange(1, width), ids, "right")
        written = np.arange(width + 1) >= width - digits[:, None]
        text = rows[written].tobytes().decode()
        begins = spans(digits + 1)[np.searchsorted(both[order], np.searchsorted(self.cuts, self.upto, "right"))].tolist()
        return [text[a : b - 1] if b > a else "" for a, b in zip([0, *begins[:-1]], begins, strict=True)]


class _Block:
    """The texts of a block as distinct chunks, and its distinct pairs in the order of shards."""

    def __init__(self, texts: pa.Array, tool: Aligner, shards: int):
        cut = chunks.after_a_space(texts)
        self.chunks, self.codes, self.offsets = _Aligned(cut.values, tool), cut.codes, cut.offsets
        doc = np.repeat(np.arange(len(texts)), np.diff(self.offsets))
        bad = np.bincount(doc, weights=~self.chunks.valid[self.codes], minlength=len(texts)) > 0
        self.valid = ~bad & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
        seen = np.bincount(self.codes, weights=self.valid[doc], minlength=len(cut.values)).astype(np.int64)
        weight = np.repeat(seen, self.chunks.numbers[:, 3])
        pairs, entry = np.unique(self.chunks.pairs, return_inverse=True)
        shard = shard_of(pairs, tool.n_pieces, shards)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.entry, self.pairs, self.shard = place[entry], pairs[order], shard[order]
        self.counts = np.bincount(self.entry, weights=weight, minlength=len(pairs)).astype(np.int64)

    def by_chunk(self, values: np.ndarray) -> np.ndarray:
        """Sums over the links of each distinct chunk of a value of their pairs."""
        upto = spans(values[self.entry])
        at = spans(self.chunks.numbers[:, 3])
        return upto[at[1:]] - upto[at[:-1]]

    def by_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over the chunks of each text of a value of theirs; zero where a text has no tokens."""
        upto = spans(values[self.codes])
        return (upto[self.offsets[1:]] - upto[self.offsets[:-1]]) * self.valid

    def groups(self) -> list[str]:
        own, codes, offsets = self.chunks.groups(), self.codes.tolist(), self.offsets.tolist()
        return [";".join([own[c] for c in codes[a:b]]) if v else "" for a, b, v in zip(offsets[:-1], offsets[1:], self.valid.tolist(), strict=True)]


def shard_of(pairs: np.ndarray, n_pieces: int, shards: int) -> np.ndarray:
    """All pairs of a second id are in one shard."""
    return (mixed(pairs % np.uint64(n_pieces)) % np.uint64(shards)).astype(np.int64)


# -- shards -----------------------------------------------------------------------------------------------------------

_SENT = pa.schema([("shard", pa.int32()), ("part", pa.int64()), ("block", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary())])
_SENT_SQL = "shard int, part long, block long, pairs binary, counts binary"
_VECTOR_SQL = "shard int, part long, counts binary"
_VECTOR = pa.schema([("shard", pa.int32()), ("part", pa.int64()), ("counts", pa.binary())])
_TABLE_SQL = "shard int, sizes array<long>, bits array<binary>, pairs binary"
_TABLE = pa.schema([("shard", pa.int32()), ("sizes", pa.list_(pa.int64())), ("bits", pa.list_(pa.binary())), ("pairs", pa.binary())])
_ANSWER_SQL = "block long, shard int, answer binary"
_ANSWER = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("answer", pa.binary())])


def _longs(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<i8")


def _pairs(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<u4").astype(np.uint64)


def _one(schema: pa.Schema, **row) -> pa.Table:
    return pa.Table.from_pydict({k: [v] for k, v in row.items()}, schema=schema)


def _summed(rows: pa.Table) -> pa.Table:
    """The distinct pairs of a shard in a part, each with its sum."""
    pairs, entry = np.unique(_pairs(rows["pairs"].to_pylist()), return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, entry, _longs(rows["counts"].to_pylist()))
    return _one(_SENT, shard=rows["shard"][0].as_py(), part=rows["part"][0].as_py(), block=0, pairs=pairs.astype("<u4").tobytes(), counts=counts.astype("<i8").tobytes())


def _hashed(rows: pa.Table) -> pa.Table:
    """The perfect hash of a shard's distinct pairs, and the pairs in the order of their slots."""
    keys = np.unique(_pairs(rows["pairs"].to_pylist()))
    made = PerfectHash.of(keys)
    by_slot = np.empty(len(keys), np.uint64)
    by_slot[made.slots(keys)] = keys
    return _one(_TABLE, shard=rows["shard"][0].as_py(), sizes=made.sizes, bits=made.packed(), pairs=by_slot.astype("<u4").tobytes())


class _Table:
    """The perfect hash of a shard, its pairs by slot and, when known, their counts."""

    def __init__(self, rows: pa.Table):
        row = rows.slice(0, 1).to_pylist()[0]
        self.hash, self.pairs = PerfectHash(row["sizes"], row["bits"]), _pairs([row["pairs"]])
        self.counts = _longs([row["counts"]]) if "counts" in row else None

    def slots(self, pairs: np.ndarray) -> np.ndarray:
        slots = self.hash.slots(pairs)
        if (slots < 0).any() or (self.pairs[slots] != pairs).any():
            raise ValueError("a pair is not among those that were hashed")
        return slots


def _vector(rows: pa.Table, table: pa.Table) -> pa.Table:
    """The dense vector of what a part counts."""
    own = _Table(table)
    counts = np.zeros(own.hash.n, np.int64)
    np.add.at(counts, own.slots(_pairs(rows["pairs"].to_pylist())), _longs(rows["counts"].to_pylist()))
    return _one(_VECTOR, shard=rows["shard"][0].as_py(), part=rows["part"][0].as_py(), counts=counts.astype("<i8").tobytes())


def _added(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, "<i8") for c in rows["counts"].to_pylist())
    return _one(_VECTOR, shard=rows["shard"][0].as_py(), part=rows["part"][0].as_py() // WIDTH, counts=total.astype("<i8").tobytes())


def _looked_up(n_pieces: int):
    """Answers to the blocks of a part: twice a pair's count, and one more where no pair of its second id has a higher one."""

    def run(rows: pa.Table, table: pa.Table) -> pa.Table:
        own = _Table(table)
        second, entry = np.unique(own.pairs % np.uint64(n_pieces), return_inverse=True)
        most = np.zeros(len(second), np.int64)
        np.maximum.at(most, entry, own.counts)
        value = 2 * own.counts + (own.counts == most[entry])
        asked = rows["pairs"].to_pylist()
        found = value[own.slots(_pairs(asked))].astype("<i8")
        bounds = spans(np.fromiter((len(p) // 4 for p in asked), np.int64, len(asked)))
        packed = [found[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.Table.from_arrays([rows["block"].combine_chunks(), rows["shard"].combine_chunks(), pa.array(packed, pa.binary())], schema=_ANSWER)

    return run


@dataclass
class Counted:
    """Blocks of texts, what they sent, and a shard's rows (shard, sizes, bits, pairs, counts)."""

    blocks: DataFrame
    sent: DataFrame
    tables: DataFrame
    shards: int
    parts: int


def _for_parts(tables: DataFrame, parts: int) -> DataFrame:
    return tables.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))


def counted(df: DataFrame, byte_vocabulary: str, piece_model: str, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Counted:
    """The first pass: all links of the corpus counted by id pair."""
    table = blocks.written(df, key, text, "alignment", block_bytes)
    size, n = table.agg(F.sum(F.aggregate("texts", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t))), F.count("*")).first()
    # a block sends a pair for some sixteen bytes of text
    shards, parts = min(MOST_SHARDS, blocks.shards_for((size or 0) // 16, PER_SHARD, 8)), max(1, -(-n // WIDTH))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_vocabulary, piece_model)
        for batch in batches:
            for row, name in enumerate(batch.column("block").to_pylist()):
                own = _Block(batch.column("texts")[row].values, tool, shards)
                bounds = np.searchsorted(own.shard, np.arange(shards + 1))
                full = np.flatnonzero(np.diff(bounds))
                packed = [own.pairs.astype("<u4"), own.counts.astype("<i8")]
                cells = [[p[bounds[s] : bounds[s + 1]].tobytes() for s in full] for p in packed]
                part = int(mixed(np.array([name], np.uint64))[0] % np.uint64(parts))
                yield pa.RecordBatch.from_pydict({"shard": full, "part": [part] * len(full), "block": [name] * len(full), "pairs": cells[0], "counts": cells[1]}, schema=_SENT)
                pa.default_memory_pool().release_unused()

    sent = session.materialise(table.mapInArrow(send, _SENT_SQL), "sent-pairs")
    sums = session.materialise(sent.groupBy("shard", "part").applyInArrow(_summed, _SENT_SQL), "summed-pairs")
    distinct, left = sums, parts
    while left > WIDTH:
        distinct = distinct.withColumn("part", F.floor(F.col("part") / WIDTH)).groupBy("shard", "part").applyInArrow(_summed, _SENT_SQL)
        left = -(-left // WIDTH)
    hashes = session.materialise(distinct.groupBy("shard").applyInArrow(_hashed, _TABLE_SQL), "pair-hashes")
    vectors = sums.groupBy("shard", "part").cogroup(_for_parts(hashes, parts).groupBy("shard", "part")).applyInArrow(_vector_or_none, _VECTOR_SQL)
    left = parts
    while left > 1:
        vectors = vectors.withColumn("part", F.floor(F.col("part") / WIDTH)).groupBy("shard", "part").applyInArrow(_added, _VECTOR_SQL)
        left = -(-left // WIDTH)
    tables = session.materialise(hashes.join(vectors.select("shard", "counts"), "shard"), "pair-counts")
    return Counted(table, sent, tables, shards, parts)


def _vector_or_none(rows: pa.Table, table: pa.Table) -> pa.Table:
    return _vector(rows, table) if len(rows) else _VECTOR.empty_table()


def pair_counts(found: Counted, piece_model: str) -> DataFrame:
    """(a, b, n): how many links of the corpus hold each pair of ids."""
    n_pieces = pieces.model_at(piece_model).n_pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs = _pairs([row["pairs"]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs // n_pieces, pa.int32()), pa.array(pairs % n_pieces, pa.int32()), pa.array(_longs([row["counts"]]))], names=["a", "b", "n"])

    return found.tables.select("pairs", "counts").mapInArrow(run, "a int, b int, n long").filter("n > 0")


def aligned(df: DataFrame, byte_vocabulary: str, piece_model: str, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text.

    ``n_best`` are links whose pair no other pair of the same second id exceeds; ``count_sum`` sums the counts of all links.
    """
    found = counted(df, byte_vocabulary, piece_model, key, text, block_bytes)
    n_pieces, shards = pieces.model_at(piece_model).n_pieces, found.shards
    look_up = _looked_up(n_pieces)
    asked = found.sent.drop("counts").groupBy("shard", "part").cogroup(_for_parts(found.tables, found.parts).groupBy("shard", "part"))
    replies = asked.applyInArrow(lambda rows, table: look_up(rows, table) if len(rows) else _ANSWER.empty_table(), _ANSWER_SQL)
    judged = found.blocks.join(blocks.answers(replies, "values"), "block", "left")

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_vocabulary, piece_model)
        for batch in batches:
            for row in range(len(batch)):
                own = _Block(batch.column("texts")[row].values, tool, shards)
                value = _longs(batch.column("values")[row].as_py() or [])
                numbers = [own.by_text(own.chunks.numbers[:, c]) for c in range(4)]
                numbers += [own.by_text(own.by_chunk(value & 1)), own.by_text(own.by_chunk(value >> 1))]
                columns = [batch.column("ids")[row].values, *(pa.array(x, pa.int64()) for x in numbers), pa.array(own.groups(), pa.string())]
                out = pa.RecordBatch.from_arrays(columns, names=[key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])
                for at in range(0, len(out), 500):
                    yield out.slice(at, 500)
                pa.default_memory_pool().release_unused()

    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return judged.mapInArrow(results, f"`{key}` long, {', '.join(f'{n} long' for n in names)}, groups string")


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    found = aligned(documents(spark, sf_dir), public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model"))
    return found.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups")


QUERIES = {"op12_alignment": _query}
