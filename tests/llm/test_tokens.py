"""Packing, SentencePiece and token files against whole-text encoding by the libraries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from larder import session
from larder.llm import packing, pieces, token_files

WORDS, BYTES, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def whole_ids(path, texts):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packing(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= capacity
    return len(by_sequence)


def test_op1_whole_table(spark, sf_dir, texts):
    rows = packing.QUERIES["op1_packing"](spark, sf_dir).collect()
    ids = {i: [*own, 0] for i, own in zip(texts, whole_ids(WORDS, list(texts.values())), strict=True)}
    want = {(i, n, s, len(own[s : s + 2048]), crc(own[s : s + 2048])) for i, own in ids.items() for n, s in enumerate(range(0, len(own), 2048))}
    assert {(r.doc_id, r.piece, r.start, r["length"], r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    total = sum(map(len, ids.values()))
    assert check_packing(rows, 2048) <= -(-total // 2048) + 3


def test_packing_awkward_rows(awkward, nothing):
    rows = packing.packed_documents(awkward, WORDS).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter([5, 5, 1, 2, 3, 4, None, 9, 7, 8])
    assert {r["length"] for r in rows if r.doc_id in (1, 2, 3)} == {1}
    check_packing(rows, 2048)
    assert packing.packed_documents(nothing, WORDS).collect() == []


@pytest.mark.parametrize("tasks", [1, 7])
def test_packing_in_rounds(spark, monkeypatch, tasks):
    """A tree of rounds loses nothing and comes near the fewest bins; items that never combine end it early."""
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", 4 * 3000 // tasks)
    random.seed(1)
    lengths = [random.choice([random.randint(1, 700), random.randint(1, 64), 100]) for _ in range(3000)]
    frame = spark.createDataFrame(list(enumerate(lengths)), "k int, length long")
    rows = packing.pack(frame, 100 * 8).collect()
    assert sorted((r.k, r["length"]) for r in rows) == sorted(enumerate(lengths))
    assert check_packing(rows, 800) <= sum(lengths) / 800 * 1.02 + 1
    apart = packing.pack(frame.selectExpr("k", "50 + length * 0 + 1 as length"), 100).collect()
    assert check_packing(apart, 100) == 3000


def test_op2_whole_table(spark, sf_dir, texts):
    model = SentencePieceProcessor(model_file=PIECES)
    rows = pieces.QUERIES["op2_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = model.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_pieces_awkward_rows(awkward, nothing):
    model = SentencePieceProcessor(model_file=PIECES)
    coded = pieces.decode(pieces.encode(awkward, PIECES), PIECES)
    assert set(coded.columns) == {*awkward.columns, "decoded"}
    for r in coded.collect():
        ids = model.encode(r.text or "", add_bos=True, add_eos=True)
        assert r.ids == ids and r.decoded == model.decode(ids)
    assert pieces.encode(nothing, PIECES).collect() == []
    assert pieces.round_trip(awkward, PIECES).count() == 10


def random_text(rng):
    bits = [" ", "  ", "\n", "\t", "\x0b", "\x85", "\xa0", "a", "B", "'s", "é", "é", "İ", "Σ", "中", "1", "!?", "▁", "the", " more", "👍", "\r\n"]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, 20)))


def test_chunks_of_random_texts(spark):
    rng = random.Random(5)
    texts = [random_text(rng) for _ in range(3000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in pieces.encode(frame, PIECES, begin=False, end=False).collect()}
    assert [got[i] for i in range(len(texts))] == SentencePieceProcessor(model_file=PIECES).encode(texts)
    path = session.scratch_path(spark, "test-tokens")
    token_files.write(frame, path, BYTES, 2)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read(spark, path)[0].collect()}
    assert [got[i] for i in range(len(texts))] == [[*ids, 2] for ids in whole_ids(BYTES, texts)]
    got = {r.doc_id: r.ids_crc32 for r in packing.pieces(frame, WORDS, 2048).collect()}
    assert [got[i] for i in range(len(texts))] == [crc([*ids, 0]) for ids in whole_ids(WORDS, texts)]


def test_op8_whole_table(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in token_files.QUERIES["op8_token_files"](spark, sf_dir).collect()}
    start = 0
    for i, ids in zip(sorted(texts), whole_ids(BYTES, [texts[i] for i in sorted(texts)]), strict=True):
        ids = [*ids, 2]
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(rows) == len(texts)


def test_token_files_awkward_rows(spark, awkward, nothing):
    path = session.scratch_path(spark, "test-tokens")
    token_files.write(awkward, path, BYTES, 2)
    rows = sorted(token_files.documents_of(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 5, 7, 8, 9]
    assert rows[1].n_tokens == rows[2].n_tokens == 1
    path = session.scratch_path(spark, "test-tokens")
    token_files.write(nothing, path, BYTES, 2)
    assert token_files.documents_of(spark, path).collect() == []


@pytest.mark.parametrize("top", [1, 2, 200, 50_000, 2**31, 2**60 - 1, 2**64 - 1])
@pytest.mark.parametrize("n", [0, 1, 59, 1024, 5000])
def test_simple8b_round_trip(top, n):
    rng = np.random.default_rng(n)
    values = (rng.random(n) ** 8 * top).astype(np.uint64)
    if n > 2:
        values[n // 2 :: 37] = np.uint64(top)
    words, offsets = token_files.pack(values)
    assert (token_files.unpack(words, offsets, n) == values).all()
    if top <= 50_000:
        assert len(words) <= n // 3 + n // 1024 + 1


def test_plain_words_by_rank_are_the_library_s():
    """Words of letters and marks, real and random, of all alphabets that take the quick path."""
    import random

    import public_tokenizers as public
    from tokenizers import Tokenizer

    from larder.llm import tokenizers_

    path, draw = public.path("byte_bpe_50k.json"), random.Random(4)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "ABCdefGHI", "éèêàçüößñæøåÉÜ", "αβγδεζηθΑΒΓ", "абвгдеёжзАБВ", "ƀǎȘșĳŒœ"]
    words = [" " + "".join(draw.choices(draw.choice(alphabets), k=draw.randrange(1, 25))) + draw.choice(["", "", ".", ",", "...", "?!"]) for _ in range(20_000)]
    words += [" it", " it's", " a1", " x²", " ", " \n", " ...", " aµ", " É.a", " d×e", " tokenization", " <|endoftext|>"]
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    ids, lengths = tokenizers_.byte_level(path).encode(words)
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
