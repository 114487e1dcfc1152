"""Language-model scores by a weighted backoff automaton.

The state after a word is that word; its arcs are the words seen after it, and its failure arc leads, at a weight, to
the root.  The root's arcs are the known words, and its failure arc stands for any unknown word.  A text is read once
from left to right: each token moves the state and adds its log-probability.  As the state after a token depends on
that token alone, all positions of a block of texts are read side by side.

    p(w | h) = L(h) * c(h w) / c(h) + (1 - L(h)) * p(w)        L: by how often h was seen
    p(w) = (1 - m) * c(w) / N, p(unknown) = m                  m: words seen once / N

Weights of failure arcs are Good-Turing estimates: the share of a state's arcs that were seen once.  The outcomes are
those of the base score, each known token and one unknown word; in every state their probabilities add up to one.

The model grows with the corpus and is never gathered in one place.  Texts are cut into blocks; a block sends its
distinct words and word pairs with their counts, sorted and packed, to shards of the hash range, which add them up and
send each block the totals of its own arcs: the part of the automaton that its texts can reach.  Only three totals are
broadcast.  Words and pairs are told apart by 64-bit hashes.

Null texts count as empty: the end token alone.  Null keys count as training rows.  Repeated rows are scored alike, and
each counts in training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import session
from larder.llm import chunks
from larder.llm.common import by_bytes, documents, fit_rows, spans, text_array

BLOCK_BYTES = 12 << 20
#: Words or pairs that a shard adds up at a time.
SHARD_ENTRIES = 1_500_000
#: Upper bounds of how often a state was seen, for its failure weight; and the weights that are tried.
SEEN = (1, 2, 4, 8, 32, 256, 4096)
STATES = len(SEEN) + 1
WEIGHTS = (0.02, 0.08, 0.2, 0.35, 0.5, 0.65, 0.8, 0.92)
_WORD, _PAIR = 0, 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shrink(values: np.ndarray) -> bytes:
    """Compressed, with the bytes of equal rank side by side."""
    import zstandard

    return zstandard.compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes(), 1)


def _grow(blob: bytes, kind: str) -> np.ndarray:
    import zstandard

    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(size, -1).T).view(kind).ravel()


# Blocks

_BLOCK = pa.schema(
    [("block", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("keys", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), ("words", pa.binary()), ("tokens", pa.binary())]
)
_BLOCK_SQL = "block long, n_words long, n_tokens long, keys array<long>, held array<boolean>, lengths array<int>, words binary, tokens binary"


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, text, held) as blocks: distinct words, and texts as numbers of words (0: the end of a text)."""
    import zstandard

    first = TaskContext.get().partitionId() << 32
    for number, batch in enumerate(by_bytes(batches, 1, BLOCK_BYTES)):
        cut = chunks.by_white_space(pc.ascii_lower(text_array(batch.column(1))))
        is_word = np.fromiter(map(bool, cut.values), bool, len(cut.values))
        name = np.cumsum(is_word)  # words are numbered from 1
        real = is_word[cut.codes]
        lengths = np.diff(spans(real)[cut.offsets]) + 1
        tokens = np.zeros(int(lengths.sum()), np.uint32)
        inner = np.ones(len(tokens), bool)
        inner[np.cumsum(lengths) - 1] = False
        tokens[inner] = name[cut.codes[real]]
        words = " ".join(filter(None, cut.values)).encode()
        row = [first + number, int(is_word.sum()), len(tokens), batch.column(0).to_pylist(), batch.column(2).to_pylist(), lengths, zstandard.compress(words, 1), _shrink(tokens)]
        yield pa.RecordBatch.from_pydict(dict(zip(_BLOCK.names, ([x] for x in row), strict=True)), schema=_BLOCK)


@dataclass
class Block:
    """A block read back.  Token 0 ends a text; the state before a text's first token is numbered ``len(hashes)``."""

    words: list[bytes]
    hashes: np.ndarray
    tokens: np.ndarray
    states: np.ndarray
    text: np.ndarray
    trains: np.ndarray

    @staticmethod
    def of(row: dict) -> Block:
        import zstandard
        from xxhash import xxh64_intdigest

        words = zstandard.decompress(row["words"]).split(b" ") if row["n_words"] else []
        hashes = np.array([xxh64_intdigest(b"\n"), *map(xxh64_intdigest, words)], np.uint64)
        tokens = _grow(row["tokens"], "<u4")
        lengths = np.array(row["lengths"], np.int64)
        states = np.concatenate([[0], tokens[:-1]]).astype(np.int64)
        states[spans(lengths)[:-1]] = len(hashes)
        text = np.repeat(np.arange(len(lengths)), lengths)
        return Block(words, hashes, tokens.astype(np.int64), states, text, ~np.array(row["held"], bool)[text])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (state, token) hashes in order, and the place of each position's among them."""
        state = np.append(self.hashes, np.uint64(0x5851F42D4C957F2D))
        mixed = (state * _MIX ^ (state >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        value = mixed[self.states] ^ self.hashes[self.tokens] * np.uint64(0x94D049BB133111EB)
        value = (value ^ (value >> np.uint64(32))) * _MIX
        return np.unique(value ^ (value >> np.uint64(29)), return_inverse=True)


# Exchange of counts

_SENT = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_SENT_SQL = "kind int, shard int, block long, keys binary, counts binary"


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of 64-bit hashes, so that sorted keys are sorted by shard."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _send(word_shards: int, pair_shards: int):
    def parts(kind: int, block: int, keys: np.ndarray, counts: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
        cuts = np.searchsorted(_shard(keys, shards), np.arange(shards + 1))
        for s in range(shards):
            a, b = cuts[s], cuts[s + 1]
            if b > a:
                own = np.diff(keys[a:b], prepend=np.uint64(0)).astype("<u8")
                yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([s], pa.int32()), pa.array([block]), pa.array([_shrink(own)], pa.binary()), pa.array([_shrink(counts[a:b].astype("<u4"))], pa.binary())], schema=_SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Block.of(row)
                counts = np.bincount(block.tokens[block.trains], minlength=len(block.hashes))
                order = np.argsort(block.hashes)
                yield from parts(_WORD, row["block"], block.hashes[order], counts[order], word_shards)
                keys, place = block.pairs()
                yield from parts(_PAIR, row["block"], keys, np.bincount(place[block.trains], minlength=len(keys)), pair_shards)

    return run


def _add_up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Totals of a shard's keys: to each block those of its keys; in a row of block -1 how many, of what sum, seen once."""
    kind, shard = key[0].as_py(), key[1].as_py()
    blocks = table["block"].to_pylist()
    keys = [np.cumsum(_grow(k, "<u8"), dtype=np.uint64) for k in table["keys"].to_pylist()]
    counts = np.concatenate([_grow(c, "<u4") for c in table["counts"].to_pylist()])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(place, weights=counts, minlength=len(distinct)).astype("<u8")
    cuts = spans(np.array([len(k) for k in keys]))
    known = totals > 0
    summary = np.array([known.sum(), totals.sum(), (totals == 1).sum()], "<u8")
    rows = [(-1, _shrink(summary), b"")]
    rows += [(b, b"", _shrink(totals[place[x:y]])) for b, x, y in zip(blocks, cuts[:-1], cuts[1:], strict=True)]
    columns = [pa.array([kind] * len(rows), pa.int32()), pa.array([shard] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())]
    return pa.Table.from_arrays(columns, schema=_SENT)


# The model


@dataclass(frozen=True)
class Totals:
    """What every task needs to know of the whole: training tokens, distinct ones, and those seen once."""

    tokens: int
    words: int
    once: int


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, plain double, once array<long>, seen array<long>, sums array<double>"


def _read(totals: Totals):
    """Scores of a block's texts, with a sum for every failure weight that a group of states might have."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        block = Block.of(row)
        got = sorted(answers.select(["kind", "shard", "counts"]).to_pylist(), key=lambda r: (r["kind"], r["shard"]))
        of_kind = lambda kind: np.concatenate([_grow(r["counts"], "<u8") for r in got if r["kind"] == kind]).astype(np.int64)
        count = np.empty(len(block.hashes), np.int64)
        count[np.argsort(block.hashes)] = of_kind(_WORD)
        keys, place = block.pairs()
        pair = of_kind(_PAIR)[place]
        n = len(row["lengths"])
        per_text = lambda values: np.bincount(block.text, weights=values, minlength=n)

        base = np.log10((count + 1) / (totals.tokens + totals.words + 1))
        m = min(max(totals.once, 1) / max(totals.tokens, 2), 0.5)
        word = np.log10(np.where(count > 0, (1 - m) * count / max(totals.tokens, 1), m))

        # the state of a text's start was seen once a training text
        state_count = np.append(count, count[0])[block.states]
        group = np.searchsorted(SEEN, state_count)
        low = word[block.tokens]
        lone = state_count == 0
        plain = per_text(np.where(lone, low, 0.0))
        slot = block.text * STATES + group
        ratio = pair / np.maximum(state_count, 1)
        seen_arc = ~lone & (pair > 0)
        unseen = ~lone & (pair == 0)
        misses = np.bincount(slot[unseen], minlength=n * STATES)
        lows = np.bincount(slot[unseen], weights=low[unseen], minlength=n * STATES)
        p_low, r, s = 10.0 ** low[seen_arc], ratio[seen_arc], slot[seen_arc]
        sums = np.empty((n, STATES, len(WEIGHTS)))
        for g, weight in enumerate(WEIGHTS):
            hits = np.bincount(s, weights=np.log10(weight * r + (1 - weight) * p_low), minlength=n * STATES)
            sums[:, :, g] = (hits + lows + misses * np.log10(1 - weight)).reshape(n, STATES)
        learned = block.trains & ~lone
        per_state = lambda which: np.bincount(slot[which], minlength=n * STATES).reshape(n, STATES)
        lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * (x.size // max(n, 1)), pa.int32()), pa.array(x.ravel()))
        columns = [
            pa.array(row["keys"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(np.array(row["lengths"], np.int64)),
            pa.array(per_text(count[block.tokens] > 0).astype(np.int64)), pa.array(per_text(base[block.tokens])), pa.array(plain),
            lists(per_state(learned & (pair == 1))), lists(per_state(learned)), lists(sums),
        ]
        return pa.Table.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "plain", "once", "seen", "sums"])

    return run


def state_weights(once: list[int], seen: list[int]) -> list[int]:
    """For each group of states the place in ``WEIGHTS`` of its weight: the share of arcs' uses that were not the only one.

    States seen once have arcs seen once only; they get half the weight of those seen twice.
    """
    share = [1 - o / s if s else 0.0 for o, s in zip(once, seen, strict=True)]
    share[0] = share[1] / 2
    return [min(range(len(WEIGHTS)), key=lambda g: abs(WEIGHTS[g] - x)) for x in share]


def score(df: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); texts not held out are learned from."""
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    blocks = session.materialise(rows.mapInArrow(_to_blocks, _BLOCK_SQL), "lm-blocks")
    size = blocks.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
    shards = [fit_rows((n or 0), SHARD_ENTRIES) for n in size]
    sent = blocks.mapInArrow(_send(*shards), _SENT_SQL)
    answers = session.materialise(sent.groupBy("kind", "shard").applyInArrow(_add_up, _SENT_SQL), "lm-answers")
    totals = _totals(answers)
    mine = answers.filter("block >= 0").select("block", "kind", "shard", "counts")
    scored = blocks.groupBy("block").cogroup(mine.groupBy("block")).applyInArrow(_read(totals), _SCORED)
    scored = session.materialise(scored, "lm-scores")
    state = [F.sum(F.get(c, F.lit(b))).alias(f"{c}{b}") for c in ("once", "seen") for b in range(STATES)]
    found = scored.agg(*state).first()
    chosen = state_weights([found[f"once{b}"] or 0 for b in range(STATES)], [found[f"seen{b}"] or 0 for b in range(STATES)])
    total = F.col("plain")
    for b, g in enumerate(chosen):
        total = total + F.get("sums", F.lit(b * len(WEIGHTS) + g))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", total.alias("score"))


def _totals(answers: DataFrame) -> Totals:
    """The sums of the word shards, three numbers each."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_grow(b, "<u8").astype(np.int64).tolist() for b in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([v[i] for v in values], pa.int64()) for i in range(3)], names=["words", "tokens", "once"])

    words = answers.filter(f"block = -1 and kind = {_WORD}").select("keys").mapInArrow(summary, "words long, tokens long, once long")
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words", "tokens", "once")]).first()
    return Totals(sums.tokens, sums.words, sums.once)


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return score(documents(spark, sf_dir), held_out)


QUERIES = {"op4_language_model": _query}
