"""Small helpers that the operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from gc import collect as drop_garbage
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java pattern of the white space between words: space and U+0009 to U+000D.
GAP = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use).getItem(0)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """The words of a text; none where it is null or empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def worker_cache(key: str, make: Callable[[], Any]) -> Any:
    """An object that a Python worker keeps between its tasks."""
    home = sys.modules.setdefault("_larder_worker_cache", types.ModuleType("_larder_worker_cache"))
    if key not in vars(home):
        setattr(home, key, make())
    return vars(home)[key]


def drop_worker_cache() -> None:
    """Lets go of what other operators keep in this Python worker, which shares its executor's memory."""
    if sys.modules.pop("_larder_worker_cache", None) is not None:
        drop_garbage()


def text_array(column: pa.Array) -> pa.Array:
    """The texts of a batch, null as empty."""
    return column.fill_null("")


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, most: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``most`` bytes in a text column; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.cumsum(sizes) - sizes
        cuts = [0, *(np.flatnonzero(np.diff(before // most)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)
        pa.default_memory_pool().release_unused()  # a worker shares its executor's memory


def spans(lengths: np.ndarray) -> np.ndarray:
    """Offsets 0, l0, l0 + l1, ... of consecutive runs."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words after which all bits depend on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fit_rows(rows: int, per_task: int, least: int = 1) -> int:
    """How many tasks give each about ``per_task`` rows: follows the input, without a ceiling."""
    return max(least, -(-rows // per_task))
