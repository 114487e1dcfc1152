"""Vocabulary files of public tokenizers as chunk encoders."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow.compute as pc

from larder.llm import chunks
from larder.llm.common import worker_cache


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # special strings in a text are ordinary text
    return tokenizer


def _vocabulary(tokenizer) -> list[str]:
    return [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]


def entries(path: str) -> list[str]:
    """The vocabulary of a file in the order of its ids."""
    return _vocabulary(_tokenizer(path))


#: Words that byte-level vocabularies of this kind cut in one way: a space and letters, then marks of a sentence.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0391-\u03a1\u03a3-\u03a9\u03b1-\u03c9\u0410-\u044f"
_PLAIN_WORD = f"^ [{_LETTERS}]+[.,;:!?]*$"


@lru_cache(1)
def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_token(entry: str) -> bytes:
    alphabet = byte_alphabet()
    return bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()


def _merged_by_rank(tokens: list[bytes]):
    """Encode plain words as one text by the rank of tokens, and cut the ids where the bytes of a word end."""
    from tiktoken import Encoding

    cut = f" [{_LETTERS}]+|[.,;:!?]+"
    quick = Encoding("ranks", pat_str=cut, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))

    def run(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = quick.encode_to_numpy("".join(words)).astype(np.uint32)
        word_ends = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
        return ids, np.diff(np.searchsorted(np.cumsum(sizes[ids]), word_ends, "right"), prepend=0)

    return run


def byte_level(path: str) -> chunks.ChunkTable:
    """Table of a byte-level vocabulary, whose tokens keep the space before a word.

    Its ids are ranks: token 256 + n is the n-th merge.  Plain words, which make up most chunks, are merged by rank, which
    gives what the library gives and takes a fifth of its time; all other chunks go to the library.
    """

    def make() -> chunks.ChunkTable:
        tokenizer = _tokenizer(path)
        names = _vocabulary(tokenizer)
        mark = np.array([t.startswith("Ġ") for t in names])
        encode = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        one_word = re.compile(r" \S+").fullmatch
        by_library = chunks.joined(encode, lambda c: int(one_word(c) is not None), "", mark, at_end=False)
        tokens = _merged_tokens(path, names)
        if tokens is None:
            return chunks.ChunkTable(by_library)
        return chunks.ChunkTable(chunks.either(lambda some: pc.match_substring_regex(some, _PLAIN_WORD), _merged_by_rank(tokens), by_library))

    return worker_cache(f"byte {path}", make)


def _merged_tokens(path: str, names: list[str]) -> list[bytes] | None:
    """The bytes of tokens by rank, if ids are the 256 bytes and then the merges in their order; added tokens come after."""
    merges = json.loads(Path(path).read_text())["model"]["merges"]
    made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
    if set(names[:256]) != set(byte_alphabet()) or made != names[256 : 256 + len(made)]:
        return None
    return [byte_token(t) for t in names[: 256 + len(made)]]


def word_end(path: str) -> chunks.ChunkTable:
    """Table of a lower-case vocabulary whose last token of a word carries an end mark and which drops white space."""

    def make() -> chunks.ChunkTable:
        tokenizer = _tokenizer(path)
        mark = np.array([t.endswith("</w>") for t in _vocabulary(tokenizer)])
        encode = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        # a run of letters is one token word, marks of a sentence after it are another
        one_or_two = re.compile(r"[^\W\d_]+([.,;:!?]*)").fullmatch

        def marks_of(chunk: str) -> int:
            found = one_or_two(chunk)
            return 0 if found is None else 2 if found[1] else 1

        return chunks.ChunkTable(chunks.joined(encode, marks_of, " ", mark, at_end=True))

    return worker_cache(f"word {path}", make)
