"""SentencePiece encoding and decoding with a distinct-chunk table.

No piece of the vocabulary has a white space marker after another character, so no merge crosses from a word to the
next marker.  Each distinct marked word of a batch is segmented once per Python worker (a bounded table keeps the
words from batch to batch) and the ids are joined back by position.  Nothing is shuffled: a table of all distinct
words of a corpus grows with it, and joining it back would move every word of every text.

Null texts count as empty and have only the begin and end ids.  Ties, repeated rows and extra columns do not matter:
rows are handled one by one, other columns are kept, and a column named like the output is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import chunks
from larder.llm.common import by_bytes, documents, spans, text_array, worker_cache


class PieceModel:
    """A SentencePiece vocabulary with its chunk table."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.n_pieces = len(self.pieces)
        self.separable = not any("▁" in piece.lstrip("▁") for piece in self.pieces)
        self.mark = self.model.piece_to_id("▁")
        self.table = chunks.ChunkTable(self._encode)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # a lone marker, which ends a text, is written as an empty word
        return chunks.flat_lists([ids if w else [self.mark] for w, ids in zip(words, self.model.encode(words, num_threads=1), strict=True)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the offset of each text in them."""
        if self.separable:
            return self.table.ids_of(chunks.marked_words(texts))
        ids, lengths = chunks.flat_lists(self.model.encode(texts.to_pylist(), num_threads=1))
        return ids, spans(lengths)

    def wrapped(self, texts: pa.Array, begin: bool, end: bool) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with the begin and end ids at either end of each text."""
        ids, offsets = self.encode(texts)
        lengths = np.diff(offsets) + begin + end
        upto = spans(lengths)
        out = np.empty(upto[-1], np.uint32)
        inner = np.ones(len(out), bool)
        if begin:
            out[upto[:-1]], inner[upto[:-1]] = self.model.bos_id(), False
        if end:
            out[upto[1:] - 1], inner[upto[1:] - 1] = self.model.eos_id(), False
        out[inner] = ids
        return out, upto

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist())


def model_at(path: str) -> PieceModel:
    return worker_cache(f"pieces {path}", lambda: PieceModel(path))


def encode(df: DataFrame, model: str, text: str = "text", out: str = "ids", begin: bool = True, end: bool = True) -> DataFrame:
    """``df`` with the ids of each text as an array in ``out``."""
    kept = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, len(kept)):
            ids, offsets = model_at(model).wrapped(text_array(batch.column("__text")), begin, end)
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), column], names=[*kept, out])

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.ArrayType(T.IntegerType()))])
    return df.select(*kept, F.col(text).alias("__text")).mapInArrow(run, schema)


def decode(df: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of each array of ids in ``out``; null ids give an empty text."""
    kept = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model_at(model).model.decode(one or []) for one in batch.column("__ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, out])

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.StringType())])
    return df.select(*kept, F.col(ids).alias("__ids")).mapInArrow(run, schema)


def round_trip(df: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encodes and decodes within a batch, so that no ids are moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model_at(model)
        for batch in by_bytes(batches, 1):
            ids, offsets = pieces.wrapped(text_array(batch.column(1)), True, True)
            sha_ids, sha_text = [], []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                own = ids[a:b]
                sha_ids.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                sha_text.append(hashlib.sha256(pieces.decode(own).encode()).hexdigest())
            columns = [batch.column(0), pa.array(np.diff(offsets)), pa.array(sha_ids, pa.string()), pa.array(sha_text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    out = T.StructType([df.schema[key], T.StructField("n_tokens", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256"))])
    return df.select(key, text).mapInArrow(run, out)


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op2_sentencepiece": _query}
