"""Substring dedup against plain sets of windows."""

from __future__ import annotations

import random
import re
import weakref

import numpy as np
import pyarrow as pa
import pytest

from larder.llm import blocks, substrings


def plain(rows, length):
    """(key, n_words, n_removed, kept) by dictionaries of windows."""
    words = [(k, re.findall("[^\x20\x09-\x0d]+", t or "")) for k, t in rows]
    order = lambda k: float("inf") if k is None else k
    first: dict[tuple, float] = {}
    for k, w in words:
        for i in range(len(w) - length + 1):
            run = tuple(w[i : i + length])
            first[run] = min(first.get(run, float("inf")), order(k))
    out = []
    for k, w in words:
        gone = {i + d for i in range(len(w) - length + 1) if first[tuple(w[i : i + length])] < order(k) for d in range(length)}
        out.append((k, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def found(df, **more):
    return sorted((tuple(r) for r in substrings.without_repeats(df, **more).collect()), key=repr)


@pytest.mark.parametrize(("length", "block_bytes"), [(13, 300), (13, 4 << 20), (8, 700), (20, 2_000)])
def test_against_plain_windows(spark, length, block_bytes):
    """Shared passages at any offset, of any length around the window's; some texts repeat within themselves."""
    draw = random.Random(7)
    passages = [[f"p{n}w{i}" for i in range(n)] for n in (length - 1, length, length + 1, 3 * length, 90)]
    rows = []
    for key in range(120):
        words = [f"d{key}x{i}" for i in range(draw.randrange(0, 40))]
        for _ in range(draw.randrange(0, 4)):
            one = draw.choice(passages)
            cut = draw.randrange(0, len(one))
            at = draw.randrange(0, len(words) + 1)
            words[at:at] = one[cut:] if draw.random() < 0.5 else one
        rows.append((key * 3 % 120, draw.choice([" ", "\n", " \t "]).join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df, length=length, block_bytes=block_bytes) == plain(rows, length)


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(awkward) == plain(rows, 13)
    assert found(awkward, block_bytes=50) == plain(rows, 13)
    assert found(nothing) == []


def test_hot_passage_nulls_ties_and_repeats(spark):
    """A passage of most rows, equal keys, null keys, and rows that repeat."""
    hot = " ".join(f"h{i}" for i in range(30))
    rows = [(i % 200, f"own{i} {hot} tail{i}") for i in range(400)] + [(None, hot), (None, hot), (5, hot), (5, hot)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(df, block_bytes=3_000) == plain(rows, 13)


def test_long_words_and_long_texts(spark):
    long = "a" * (substrings.SEGMENT + 5)
    words = [f"w{i % 400}" for i in range(300_000)]
    rows = [(1, " ".join(["x", long] * 10)), (2, " ".join(["x", long] * 10)), (3, " ".join(words)), (4, " ".join(words[:30]) + " é中 " + long + "b")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows, 13)


def test_hashes_do_not_depend_on_place():
    """A word has one hash wherever it stands, also across segments."""
    words = ["".join(random.Random(i % 97).choices("abé0", k=1 + i % 9)) for i in range(400_000)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    hashes, starts, ends = substrings.word_hashes(data)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts[:50], ends[:50], strict=True)] == words[:50]
    by_word: dict[str, set] = {}
    for word, value in zip(words, hashes.tolist(), strict=True):
        by_word.setdefault(word, set()).add(value)
    assert all(len(v) == 1 for v in by_word.values())
    assert len({min(v) for v in by_word.values()}) == len(by_word)


def test_narrow_hashes_come_back():
    hashes = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 5_000, np.uint64))
    cuts = blocks.cuts_of(hashes, 64)
    packed = [blocks.narrow(hashes, 64, 5)[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    assert cuts[-1] == 5_000 and (np.diff(cuts) > 0).all()
    assert (blocks.widened(packed, 5) == (hashes << np.uint64(6)) >> np.uint64(24)).all()


def test_hashing_holds_little():
    """Bytes are hashed in short segments, and a word has one hash wherever a segment ends."""
    import tracemalloc

    data = np.frombuffer(b"some words of a text " * 200_000, np.uint8)
    starts, ends = substrings.word_spans(data)
    substrings.span_hashes(data, starts[:5], ends[:5])
    tracemalloc.start()
    hashes = substrings.span_hashes(data, starts, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(np.unique(hashes)) == 5 and (hashes[:5] == hashes[-5:]).all()
    assert peak - hashes.nbytes < 32 << 20


def test_a_worker_holds_one_block(monkeypatch):
    """A block and what was made of it are gone when the next one is made; blocks are of 2 MB or less."""
    alive, most = weakref.WeakSet(), []

    class Seen(substrings._Block):
        def __init__(self, *arguments):
            alive.add(self)
            most.append(len(alive))
            super().__init__(*arguments)

    monkeypatch.setattr(substrings, "_Block", Seen)
    texts = [[" ".join(f"w{b}x{i}" for i in range(40))] for b in range(4)]
    batch = pa.record_batch({"block": pa.array(range(4), pa.int64()), "ids": pa.array([[b] for b in range(4)]), "texts": pa.array(texts)})
    sent = list(substrings._each_block(iter([batch, batch]), 13, lambda batch, row, name, block: substrings._sent(name, block.anchor, 32, False)))
    assert sent and most == [1] * 8
    assert substrings.BLOCK_BYTES <= 2 << 20
