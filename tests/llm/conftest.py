from __future__ import annotations

import pytest

#: Nulls, empty and very long texts, ties, repeated rows.
AWKWARD = [
    (5, "A word, two words\nand  more"), (1, None), (2, ""), (3, "   \n\t "), (4, "é́ Σς 中文\x85\x0b <|endoftext|></s> ▁x "),
    (5, "A word, two words\nand  more"), (None, "no id"), (9, "long text " * 30_000), (7, "A word, two words\nand  more"), (8, "x"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Awkward rows with further columns whose names clash with those the operators use."""
    rows = [(i, t, "en", "src0", 1.5, "x", 3, "y", True) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, length double, key string, shard int, ids string, kept boolean")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("doc_id > 1000")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}
