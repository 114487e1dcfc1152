"""Distinct-chunk tables: each distinct chunk of text is encoded once, its ids are joined back by position.

A tokenizer whose tokens never cross certain boundaries can encode the chunks between them on their own.  A batch is
cut into chunks and dictionary-encoded (vectorised); only chunks new to the Python worker go to the tokenizer.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from larder.llm.common import spans

Encode = Callable[[list[str]], Sequence[Sequence[int]]]

#: A space after a character that no tokenizer counts as white space.
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
_RUN_OF_SPACES = re.compile(r"(?<=[^ ▁])(?= )")


@dataclass
class Chunks:
    """Texts as codes of distinct chunks; text i has codes[offsets[i]:offsets[i + 1]]."""

    values: list[str]
    codes: np.ndarray
    offsets: np.ndarray


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of runs, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


class ChunkTable:
    """Ids of the chunks seen by one worker; emptied beyond ``limit`` chunks, so its memory is bounded."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 550_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(4096, np.uint32), 0

    def _add(self, chunks: list[str]) -> None:
        for at in range(0, len(chunks), 20_000):
            part = chunks[at : at + 20_000]
            ids, lengths = self.encode(part)
            first = len(self.place)
            while first + len(part) > len(self.starts):
                self.starts = np.resize(self.starts, 2 * len(self.starts))
                self.lengths = np.resize(self.lengths, 2 * len(self.lengths))
            while self.used + len(ids) > len(self.flat):
                self.flat = np.resize(self.flat, 2 * len(self.flat))
            self.starts[first : first + len(part)] = self.used + spans(lengths)[:-1]
            self.lengths[first : first + len(part)] = lengths
            self.flat[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
            self.place.update(zip(part, range(first, first + len(part)), strict=True))

    def ids_of(self, chunks: Chunks) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one flat array, and the offsets of the texts in it."""
        if len(self.place) > self.limit:
            self._clear()
        known = self.place
        self._add([c for c in dict.fromkeys(chunks.values) if c not in known])
        rows = np.fromiter(map(known.__getitem__, chunks.values), np.int64, len(chunks.values))
        starts, lengths = self.starts[rows][chunks.codes], self.lengths[rows][chunks.codes]
        return self.flat[gather(starts, lengths)], spans(lengths)[chunks.offsets]


def flat_lists(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one array and their lengths."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum())), lengths


def joined(encode: Encode, marks_of: Callable[[str], int], glue: str, mark: np.ndarray, at_end: bool, group: int = 256):
    """Encode plain chunks many at a time, as one text cut again at marked ids, which saves a call for each chunk.

    ``marks_of`` tells how many marked ids a chunk has, among them its first (or its last, ``at_end``); none for a
    chunk that is not plain.  A group whose marks do not add up is encoded chunk by chunk, as are chunks not plain.
    """

    def run(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        marks_in = np.fromiter(map(marks_of, chunks), np.int64, len(chunks))
        where = np.flatnonzero(marks_in)
        lengths, parts, order, single = np.zeros(len(chunks), np.int64), [], [], [np.flatnonzero(marks_in == 0)]
        groups = [where[i : i + group] for i in range(0, len(where), group)]
        for own, ids in zip(groups, encode([glue.join([chunks[i] for i in g]) for g in groups]), strict=True):
            ids = np.array(ids, np.uint32)
            marks, upto = np.flatnonzero(mark[ids]), np.cumsum(marks_in[own])
            if len(marks) != upto[-1] or (marks[-1] != len(ids) - 1 if at_end else marks[0] != 0):
                single.append(own)
                continue
            lengths[own] = np.diff(marks[upto - 1], prepend=-1) if at_end else np.diff(marks[upto - marks_in[own]], append=len(ids))
            parts.append(ids)
            order.append(own)
        rest = np.concatenate(single)
        ids, lengths[rest] = flat_lists(encode([chunks[i] for i in rest]))
        flat, order = np.concatenate([*parts, ids]), np.concatenate([*order, rest])
        starts = np.empty(len(chunks), np.int64)
        starts[order] = spans(lengths[order])[:-1]
        return flat[gather(starts, lengths)], lengths

    return run


def either(plain: Callable[[pa.Array], pa.Array], one: Callable, other: Callable):
    """Encode the chunks that ``plain`` says are so by ``one``, all others by ``other``."""

    def run(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flags = plain(pa.array(chunks, pa.string())).to_numpy(zero_copy_only=False)
        own = [np.flatnonzero(flags), np.flatnonzero(~flags)]
        made = [how([chunks[i] for i in at.tolist()]) for how, at in zip((one, other), own, strict=True)]
        flat, order = np.concatenate([ids for ids, _ in made]), np.concatenate(own)
        lengths, starts = np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64)
        lengths[order] = np.concatenate([n for _, n in made])
        starts[order] = spans(lengths[order])[:-1]
        return flat[gather(starts, lengths)], lengths

    return run


def _coded(lists: pa.ListArray) -> tuple[list[str], np.ndarray, np.ndarray]:
    flat = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return flat.dictionary.to_pylist(), flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0]


def _mixed(texts: pa.Array, odd: pa.Array, quick: Callable[[pa.Array], Chunks], slow: Callable[[str], list[str]]) -> Chunks:
    """Chunks by ``quick``, but for the odd texts by ``slow``."""
    flags = odd.to_numpy(zero_copy_only=False)
    if not flags.any():
        return quick(texts)
    own = quick(texts.filter(pc.invert(odd)))
    values, codes, offsets = _coded(pa.array([slow(t) for t in texts.filter(odd).to_pylist()], pa.list_(pa.string())))
    starts, lengths = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
    starts[~flags], lengths[~flags] = own.offsets[:-1], np.diff(own.offsets)
    starts[flags], lengths[flags] = len(own.codes) + offsets[:-1], np.diff(offsets)
    both = np.concatenate([own.codes, codes + len(own.values)])
    return Chunks(own.values + values, both[gather(starts, lengths)], spans(lengths))


def by_white_space(texts: pa.Array) -> Chunks:
    """Chunks for tokenizers that drop white space: runs between ASCII white space, empty ones included."""
    return Chunks(*_coded(pc.ascii_split_whitespace(texts)))


def before_spaces(texts: pa.Array) -> Chunks:
    """Chunks that each begin with the space before a word, for tokenizers that keep it with the word."""

    def quick(some: pa.Array) -> Chunks:
        values, codes, offsets = _coded(pc.split_pattern(some, " "))
        first = offsets[:-1]
        heads, own = np.unique(codes[first], return_inverse=True)
        codes[first] = len(values) + own
        return Chunks([" " + v for v in values] + [values[h] for h in heads], codes, offsets)

    odd = pc.match_substring_regex(texts, r"(^ )|([\s\x0b\x1c-\x1f\x{85}\p{Z}] )")
    return _mixed(texts, odd, quick, _BEFORE_SPACE.split)


def after_a_space(texts: pa.Array) -> Chunks:
    """Chunks of a space and each text, that each begin with the space before a word; an empty text is one space."""

    def quick(some: pa.Array) -> Chunks:
        values, codes, offsets = _coded(pc.split_pattern(some, " "))
        return Chunks([" " + v for v in values], codes, offsets)

    odd = pc.match_substring_regex(texts, r"(^ )|([\s\x0b\x1c-\x1f\x{85}\p{Z}] )")
    return _mixed(texts, odd, quick, lambda t: _BEFORE_SPACE.split(" " + t))


def marked_words(texts: pa.Array) -> Chunks:
    """Chunks that begin with a run of spaces, without their first space; a text starts with an unwritten space.

    An empty text has no chunk.
    """
    odd = pc.or_(pc.match_substring_regex(texts, "(^ )|([ ▁] )"), pc.equal(pc.binary_length(texts), 0))
    slow = lambda t: [c[1:] for c in _RUN_OF_SPACES.split(" " + t)] if t else []
    return _mixed(texts, odd, lambda some: Chunks(*_coded(pc.split_pattern(some, " "))), slow)
