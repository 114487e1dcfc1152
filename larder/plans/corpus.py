"""Vector corpus per phase: split, inflate, look up vectors."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import sampling, vectors


def vector_corpus(
    rows: DataFrame,
    category: str,
    categories: Sequence[Any],
    id_key: str,
    adhoc: DataFrame,
    static: DataFrame,
    static_keys: Sequence[str],
    adhoc_vector: str = "embedding",
    static_vector: str = "vector",
    inflate_first: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Rows with both vectors, their phase and copy number.

    The split comes first and only the training rows are inflated, so no copy of
    a training row reaches another phase.  ``inflate_first`` repeats the rows of
    all phases; copies still share a phase, as it is a function of the id.
    ``unique`` tells that both vector tables have one vector per key.
    """
    listed = rows.filter(F.col(category).isin(list(categories)))
    phased = sampling.split_phases(listed, [id_key])
    if inflate_first:
        repeated = sampling.inflate_classes(phased, category, categories)
    else:
        train = sampling.inflate_classes(phased.filter("phase = 'train'"), category, categories)
        held_out = phased.filter("phase <> 'train'").withColumn("copy", F.lit(1))
        repeated = sampling.union_all(train, held_out)
    return vectors.lookup_vectors(repeated, adhoc, static, id_key, static_keys, adhoc_vector, static_vector, unique)
