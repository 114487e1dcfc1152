"""Language model: base scores and the automaton's own scores against a plain model, normalisation, odd rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.llm import language_model as lm


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w] + ["\n"]


class Plain:
    """The model by dictionaries."""

    def __init__(self, texts):
        own = [tokens(t) for t in texts]
        self.count = Counter(w for t in own for w in t)
        self.pair = Counter(p for t in own for p in zip(["^", *t], t, strict=False))
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.once = sum(c == 1 for c in self.count.values())
        once, seen = [0] * lm.STATES, [0] * lm.STATES
        for (h, _), c in self.pair.items():
            seen[self.group(h)] += c
            once[self.group(h)] += c == 1
        self.weight = [lm.WEIGHTS[g] for g in lm.state_weights(once, seen)]

    def seen(self, h):
        return self.count["\n"] if h == "^" else self.count[h]

    def group(self, h):
        return next((i for i, most in enumerate(lm.SEEN) if self.seen(h) <= most), len(lm.SEEN))

    def base(self, text):
        return sum(math.log10((self.count[w] + 1) / (self.n + self.v + 1)) for w in tokens(text))

    def p(self, h, w):
        m = min(max(self.once, 1) / self.n, 0.5)
        low = (1 - m) * self.count[w] / self.n if self.count[w] else m
        if not self.seen(h):
            return low
        weight = self.weight[self.group(h)]
        return weight * self.pair[h, w] / self.seen(h) + (1 - weight) * low

    def score(self, text):
        own = tokens(text)
        return sum(math.log10(self.p(h, w)) for h, w in zip(["^", *own], own, strict=False))


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def check(rows, texts):
    plain = Plain([t for i, t in texts.items() if not held(i)])
    for r in rows:
        own = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.doc_id), len(own), plain.n)
        assert r.n_known == sum(plain.count[w] > 0 for w in own)
        assert r.base_score == pytest.approx(plain.base(texts[r.doc_id]))
        assert r.score == pytest.approx(plain.score(texts[r.doc_id]))


def test_op4_whole_table(spark, sf_dir, texts):
    rows = lm.QUERIES["op4_language_model"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


@pytest.mark.parametrize("entries", [50, 10**6])
def test_blocks_and_shards(spark, texts, monkeypatch, entries):
    """Many small shards and blocks give the same scores."""
    monkeypatch.setattr(lm, "SHARD_ENTRIES", entries)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000 if entries == 50 else 1 << 20)
    some = {i: t for i, t in texts.items() if i < 25}
    frame = spark.createDataFrame(list(some.items()), "doc_id long, text string").repartition(3)
    check(lm.score(frame, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).collect(), some)


def test_probabilities_add_up(texts):
    plain = Plain(list(texts.values())[:20])
    for h in ("^", "the", "no such word", *list(plain.count)[:20]):
        if h != "\n":
            assert sum(plain.p(h, w) for w in plain.count) + plain.p(h, "unknown \t") == pytest.approx(1)


def test_awkward_rows(awkward, nothing):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows = lm.score(awkward, held_out).collect()
    assert len(rows) == 10 and {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert next(r.n_tokens for r in rows if r.doc_id == 9) == 60_001 and all(r.score <= 0 for r in rows)
    assert lm.score(nothing, held_out).collect() == []
    alone = lm.score(awkward, F.lit(True)).collect()
    assert {r.train_tokens for r in alone} == {0} and all(math.isfinite(r.score) for r in alone)
