"""SimHash fingerprints, links and components against brute force."""

from __future__ import annotations

import random
import re
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from larder.llm import common, near_copies, simhash


def fingerprint(text, n=3):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(values, radius):
    """The smallest index each value reaches, by comparing all pairs."""
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_op9_whole_table(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in simhash.QUERIES["op9_simhash"](spark, sf_dir).collect()}
    ids = sorted(texts)
    values = [fingerprint(texts[i]) for i in ids]
    assert [rows[i].fingerprint for i in ids] == [f"{v:016x}" for v in values]
    assert [rows[i].component_id for i in ids] == [ids[k] for k in reach(values, 2)]


def clustered(rng, n, flips):
    bases = [rng.getrandbits(64) for _ in range(max(1, n // 20))]
    out = []
    for _ in range(n):
        v = rng.choice(bases)
        for _ in range(rng.randint(0, flips)):
            v ^= 1 << rng.randrange(64)
        out.append(v)
    return out


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("block_rows", [8, 100_000])
def test_components_by_brute_force(spark, radius, block_rows):
    rng = random.Random(radius)
    values = clustered(rng, 300, 4) + [0, 0, 2**64 - 1, 2**64 - 4]
    rows = [(i, int(np.uint64(v).view(np.int64))) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "k long, fingerprint long")
    got = {r.k: r.component_id for r in simhash.component_of(frame, "k", radius, block_rows=block_rows).collect()}
    assert [got[i] for i in range(len(values))] == reach(values, radius)


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 400])
def test_bit_sliced_pairs(n):
    rng = random.Random(n)
    values = np.array(clustered(rng, n, 3) + clustered(rng, n, 3), np.uint64).reshape(-1, 1)
    bounds = np.array([0, n, 2 * n])
    found = {(int(i), int(j)) for a, b in simhash.near_pairs(values, bounds, 2) for i, j in zip(a, b, strict=True)}
    want = {(i, j) for lo, hi in ((0, n), (n, 2 * n)) for i in range(lo, hi) for j in range(i + 1, hi) if (int(values[i, 0]) ^ int(values[j, 0])).bit_count() <= 2}
    assert found == want


def test_bit_sliced_pairs_of_wide_values():
    rng = random.Random(8)
    rows = [[rng.getrandbits(64) for _ in range(3)] for _ in range(20)]
    rows = [[w ^ (rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64)) for w in rng.choice(rows)] for _ in range(200)]
    values = np.array(rows, np.uint64)
    found = {(int(i), int(j)) for a, b in simhash.near_pairs(values, np.array([0, 200]), 33) for i, j in zip(a, b, strict=True)}
    apart = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(a, b, strict=True))
    assert found == {(i, j) for i in range(200) for j in range(i + 1, 200) if apart(rows[i], rows[j]) <= 33} and found


def test_near_copies(spark, awkward, nothing):
    """Texts with one of a hundred words changed are found; half-equal ones are not."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for base in range(0, 240, 4):
        words = [word() for _ in range(100)]
        for copy in range(3):
            own = list(words)
            for _ in range(copy > 0):
                own[rng.randrange(100)] = word()
            rows.append((base + copy, " ".join(own).capitalize() + "." * copy))
        rows.append((base + 3, " ".join(words[:50] + [word() for _ in range(50)])))
    got = {r.key: r for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()}
    for i, _ in rows:
        assert got[i].component_id == (i if i % 4 == 3 else i - i % 4)
        assert got[i].rank == (1 if i % 4 in (0, 3) else None)
    assert near_copies.near_copies(awkward, "doc_id").count() == 10 and near_copies.near_copies(nothing, "doc_id").count() == 0


def resemblance(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def of_words(rng):
    return lambda: "".join(rng.choice("abcdefghij") for _ in range(6))


def test_contiguous_edits_at_the_limit(spark):
    """Copies trimmed, with a paragraph replaced or a header added, of resemblance 0.80 to 0.85: all are found."""
    rng = random.Random(12)
    word = of_words(rng)
    rows, pairs = [], []
    for base in range(0, 1200, 2):
        words = [word() for _ in range(rng.randint(80, 400))]
        n, kind = len(words) - 4, rng.randrange(3)
        for _ in range(200):
            cut = rng.randint(1, n // 4)
            if kind == 0:
                copy = words[: len(words) - cut]
            elif kind == 1:
                at = rng.randrange(len(words) - cut)
                copy = [*words[:at], *(word() for _ in range(cut)), *words[at + cut :]]
            else:
                copy = [*(word() for _ in range(cut)), *words]
            if 0.8 <= resemblance(" ".join(words), " ".join(copy)) <= 0.85:
                break
        else:
            continue
        rows += [(base, " ".join(words)), (base + 1, " ".join(copy))]
        pairs.append(base)
    assert len(pairs) > 550
    got = {r.key: r.component_id for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()}
    assert [b for b in pairs if got[b + 1] != b] == []


def test_links_by_exact_resemblance(spark, monkeypatch):
    """Texts around the limit and many that share a passage: components are those of exact resemblance, whatever is frequent."""
    rng = random.Random(21)
    word = of_words(rng)
    passage, texts = [word() for _ in range(60)], []
    for _ in range(120):  # a shared passage of resemblance 0.45 to 0.7 to each other, and some of more
        texts.append([word() for _ in range(rng.randint(3, 12))] + passage + [word() for _ in range(rng.randint(3, 12))])
    for _ in range(40):  # chains of copies of copies around the limit
        words = [word() for _ in range(rng.randint(30, 120))]
        for _ in range(5):
            texts.append(words)
            cut = rng.randint(1, len(words) // 8)
            words = [*words[cut:], *(word() for _ in range(rng.randint(0, 6)))]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    label = list(range(len(rows)))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if resemblance(rows[i][1], rows[j][1]) >= 0.8]
    for _ in rows:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.key: r.component_id for r in near_copies.near_copies(frame, "doc_id").collect()}
    assert [got[i] for i in range(len(rows))] == label and 150 < len(set(label)) < len(rows)
    monkeypatch.setattr(near_copies, "FREQUENT", 10**9)
    got = {r.key: r.component_id for r in near_copies.near_copies(frame, "doc_id").collect()}
    assert [got[i] for i in range(len(rows))] == label


def test_masks_cover_all_near_pairs():
    for radius in (1, 2, 3):
        for n in (10, 10**5, 10**8, 10**10):
            masks = simhash.tables_for(n, radius)
            rng = random.Random(n)
            for _ in range(200):
                difference = sum({1 << rng.randrange(64) for _ in range(radius)})
                assert any(not difference & m for m in masks)


def test_awkward_rows(awkward, nothing):
    rows = simhash.component_of(simhash.with_fingerprint(awkward, ["doc_id"]), "doc_id", 2).collect()
    assert len(rows) == 10
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert {r.component_id for r in rows if r.doc_id in (5, 7)} == {5}
    assert simhash.component_of(simhash.with_fingerprint(nothing, ["doc_id"]), "doc_id", 2).collect() == []


def test_bits_rule_out_no_pair_that_is_alike():
    rng, ruled_out = np.random.default_rng(8), 0
    for _ in range(400):
        n = int(rng.integers(1, 900))
        one = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        lost = int(rng.integers(0, n // 2 + 1))
        two = np.unique(np.concatenate([one[lost:], rng.integers(0, 1 << 64, int(rng.integers(0, n // 3 + 1)), np.uint64)]))
        flat, offsets = np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)])
        common = len(np.intersect1d(one, two))
        alike = 5 * common >= 4 * (len(one) + len(two) - common)
        possible = near_copies.may_be_alike(*near_copies.bit_sets(flat, offsets), len(one), len(two))
        assert possible or not alike
        ruled_out += not possible
    assert ruled_out > 150


def test_fingerprints_link_first(spark, monkeypatch):
    """With a radius the SimHash operator joins what it links, and nothing of that is left for the exact comparison."""
    words = [f"w{i}" for i in range(3000)]
    one = " ".join(words)
    rows = [(1, one), (2, one + " more"), (3, " ".join(words[:-500])), (4, "quite another text of a few words"), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    seen, components_of = [], near_copies.component_of
    monkeypatch.setattr(near_copies, "component_of", lambda *a: seen.append(a[2]) or components_of(*a))
    got = {r.key: r.component_id for r in near_copies.near_copies(frame, "doc_id", radius=2).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5} and seen == [2]
    prints = simhash.with_fingerprint(frame, ["doc_id"])
    linked = {r.doc_id: r.component_id for r in simhash.component_of(prints, "doc_id", 2).collect()}
    assert linked[2] == 1 and linked[3] == 3


def test_one_text_of_a_node_gathers_repeated_rows_only(spark):
    """Each node gets one row, null keys too; the rows that are gathered to drop repeats are the repeated ones."""
    made = [(k, k * 7, f"text {k}") for k in range(40)] + [(None, 5, "none"), (3, 21, "text 3"), (3, 21, "text 3"), (None, 5, "none")]
    own = spark.createDataFrame(made, "key long, tie long, text string").repartition(3)
    meeting = spark.createDataFrame([(100 + k, k, k * 7) for k in range(20)] + [(99, None, 5)], "node long, k long, t long")
    got = near_copies._one_text(own, own.select("key", "tie"), meeting)
    assert sorted((r["node"], r["text"]) for r in got.collect()) == [(99, "none"), *((100 + k, f"text {k}") for k in range(20))]
    alone = got.filter("not again").collect()
    assert sorted(r["node"] for r in got.filter("again").collect()) == [99, 103] and len(alone) == 19


def test_a_worker_holds_little_while_it_makes_slices(monkeypatch):
    """A slice is hashed in parts, and what other operators keep in the worker goes first."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(9999)}" for _ in range(600)) for _ in range(600)] + [None, "", "a", "long " * 5_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], names=["key", "tie", "text"])
    monkeypatch.setattr(near_copies, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    common.worker_cache("made by another operator", list).append(1)
    make = near_copies._slices(np.zeros(0, np.uint64), True)
    tracemalloc.start()
    try:
        got = list(make(iter([batch])))
        _, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert common.worker_cache("made by another operator", list) == []
    assert most < 24 << 20, most
    assert len(got) > 1 and [k for r in got for k in r["keys"][0].as_py()] == list(range(len(texts)))
    flat, offsets = near_copies.shingle_sets(pa.array(texts).fill_null(""))
    head, cuts = near_copies.prefixes(flat, offsets, np.zeros(0, np.uint64))
    assert [n for r in got for n in r["sizes"][0].as_py()] == np.diff(offsets).tolist()
    assert [n for r in got for n in r["heads"][0].as_py()] == np.diff(cuts).tolist()
    assert b"".join(r["prefix"][0].as_py() for r in got) == head.tobytes()
    prints = simhash.fingerprints(pa.array(texts).fill_null(""), 3).view(np.int64)
    assert [n for r in got for n in r["prints"][0].as_py()] == prints.tolist()
