"""Alignment against token byte ranges taken one by one, and the perfect hash by itself."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pytest

import __spark_entry__ as entry_points
from larder.llm import alignment

A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


def byte_letters():
    """Bytes by the letters of byte-level vocabularies, as the library's own decoder gives them."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@pytest.fixture(scope="module")
def plain():
    """For (key, text) rows: the operator's rows, from the libraries' encodings of whole texts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, two, letters = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), byte_letters()
    one.encode_special_tokens = True

    def piece(p):
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def cut(tokens):
        at, out = 0, []
        for i, raw in tokens:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    def run(rows):
        found, counts = [], Counter()
        for key, text in rows:
            a, b = [], []
            if text:
                a = [(i, bytes(letters[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
                b = [(i, piece(two.id_to_piece(i))) for i in two.encode(text)]
                whole = (" " + text).encode()
                if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
                    a, b = [], []
            a, b = cut(a), cut(b)
            cuts = sorted({x[2] for x in a} & {x[2] for x in b})
            links, start = [], 0
            for i, s, e in a:
                while start < len(b) and b[start][2] <= s:
                    start += 1
                k = start
                while k < len(b) and b[k][1] < e:
                    links.append((i, b[k][0]))
                    k += 1
            groups, low = [], 0
            pa_, pb = 0, 0
            for end in cuts:
                ga, gb = [], []
                while pa_ < len(a) and a[pa_][2] <= end:
                    ga.append(a[pa_][0])
                    pa_ += 1
                while pb < len(b) and b[pb][2] <= end:
                    gb.append(b[pb][0])
                    pb += 1
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                low = end
            counts.update(links)
            found.append((key, len(a), len(b), len(groups), links, ";".join(groups)))
        best = defaultdict(int)
        for (_, b), n in counts.items():
            best[b] = max(best[b], n)
        return counts, sorted(
            ((k, na, nb, ng, len(ls), sum(counts[p] == best[p[1]] for p in ls), sum(counts[p] for p in ls), text) for k, na, nb, ng, ls, text in found), key=repr
        )

    return run


def found(df, **more):
    return sorted((tuple(r) for r in alignment.aligned(df, A, B, **more).collect()), key=repr)


def test_awkward_rows(spark, plain, awkward, nothing):
    more = [(10, "▁"), (11, "tab\tand  two spaces "), (12, " leading"), (13, "\n\n x \n  y　z  w"), (14, "a" * 5000), (15, "héllo wörld 🎉🎉 naïve"), (16, " "), (17, "\x00 \x01"), (18, "it's we're   odd")]
    rows = [(r.doc_id, r.text) for r in awkward.collect()] + more
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counts, want = plain(rows)
    assert found(df) == want
    assert found(df, block_bytes=40) == want
    assert found(nothing) == []
    got = alignment.pair_counts(alignment.counted(df, A, B, block_bytes=60), B).collect()
    assert {(r.a, r.b): r.n for r in got} == dict(counts)


def test_whole_table(spark, sf_dir, plain, docs):
    _, want = plain([(r.doc_id, r.text) for r in docs.collect()])
    got = sorted((tuple(r) for r in entry_points.queries()["op12_alignment"](spark, sf_dir).collect()), key=repr)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest() if t else ""
    assert got == sorted(((*r[:7], digest(r[7])) for r in want), key=repr)


def test_trees_of_several_levels(spark, docs, monkeypatch):
    """Many blocks and a narrow tree give what one block gives."""
    whole = found(docs)
    monkeypatch.setattr(alignment, "WIDTH", 3)
    assert found(docs, block_bytes=40_000) == whole


@pytest.mark.parametrize("n", [0, 1, 2, 1_000, 300_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 40, n, np.uint64))
    made = alignment.PerfectHash.of(keys)
    again = alignment.PerfectHash(made.sizes, made.packed())
    assert sorted(made.slots(keys).tolist()) == list(range(len(keys)))
    assert (again.slots(keys) == made.slots(keys)).all()
    assert sum(made.sizes) <= 64 * 12 + 5 * len(keys)
