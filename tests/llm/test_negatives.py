"""Hard negatives against all inner products, and the order in which cells are visited."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from larder.llm import negatives


def plain(rows, asks, positives=5, least=3, between=(50, 95)):
    """All scores of every anchor, sorted."""
    rows = sorted({(i, lab, tuple(v)) for i, lab, v in rows if i is not None and lab is not None and v is not None and None not in v})
    width = max((len(v) for _, _, v in rows), default=0)
    rows = [(i, lab, [*v, *[0] * (width - len(v))]) for i, lab, v in rows]
    firsts = {}
    for row in rows:
        firsts.setdefault(row[0], row)
    out = []
    for a, label, v in (r for i, r in firsts.items() if asks(i)):
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, lab) for i, lab, w in rows if i != a)
        for p, pid, _ in [s for s in scored if s[2] == label][:positives]:
            found = [s for s in scored if s[2] != label and between[0] * -p <= 100 * -s[0] <= between[1] * -p][:least]
            out += [(a, pid, rank, i, -p, -s) for rank, (s, i, _) in enumerate(found, 1)]
    return sorted(out)


def found(spark, rows, asks, **more):
    df = spark.createDataFrame(rows, "vec_id long, label long, vector array<long>").repartition(4)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r) for r in negatives.mined(df, asks(F.col("vec_id")), id="vec_id", **more).select(*names).collect())


def vectors(n, dims, spread, seed=1):
    draw = np.random.default_rng(seed)
    return [(int(i), int(draw.integers(0, 4)), draw.integers(-spread, spread + 1, dims).tolist()) for i in draw.permutation(n)]


@pytest.mark.parametrize(("n", "dims", "spread", "blocks"), [(700, 6, 40, False), (600, 5, 2, False), (900, 8, 300, True)])
def test_against_all_products(spark, monkeypatch, n, dims, spread, blocks):
    """Small spreads make many ties; small cells and blocks make many rounds and pairs of blocks."""
    monkeypatch.setattr(negatives, "CELL_ROWS", 16)
    if blocks:
        monkeypatch.setattr(negatives, "BLOCK_ROWS", 13)
        monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 11)
    rows = vectors(n, dims, spread)
    assert found(spark, rows, lambda i: i % 9 == 0) == plain(rows, lambda i: i % 9 == 0)


def test_awkward_rows(spark):
    rows = [
        (0, 1, [3, 4]), (0, 1, [3, 4]), (0, 2, [9, 9]), (2, 1, [3, 4]), (4, 1, [3, 5]), (4, 1, [3, 5]), (5, 2, [2, 3]), (7, 2, [2, 3]), (None, 2, [2, 3]),
        (8, None, [2, 3]), (10, 2, None), (11, 2, [None, 3]), (12, 2, [4]), (14, 1, []), (16, 2, [-3, -4]), (18, 1, [1 << 40, 1 << 40]), (20, 2, [1 << 39, 1 << 40]),
    ]
    assert found(spark, rows, lambda i: i % 2 == 0) == plain(rows, lambda i: i % 2 == 0)
    assert found(spark, rows[:0], lambda i: i % 2 == 0) == []
    assert found(spark, [(1, 1, [1])], lambda i: i % 2 == 1) == []


def test_extra_columns_and_hot_cell(spark, monkeypatch):
    """Half of all rows are one vector; other columns carry names that the operator uses."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 20)
    rows = [(i, i % 3, [5, 5, 1]) for i in range(200)] + [(200 + i, i % 3, [i % 7, 5, i % 11]) for i in range(200)]
    df = spark.createDataFrame([(*r, 1, "x", 2.0, 3) for r in rows], "id long, label long, vector array<long>, one int, anchor string, score double, block int")
    got = negatives.mined(df, F.col("id") % 20 == 0)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(tuple(r) for r in got.select(*names).collect()) == plain(rows, lambda i: i % 20 == 0)


def test_cells_come_by_falling_bound():
    draw = np.random.default_rng(3)
    one, two = draw.normal(size=13), draw.normal(size=9)
    full = frozenset((i, j) for i in range(13) for j in range(9) if (i * j) % 4 != 1)
    got = list(negatives.by_bound([one, two], full))
    assert {(i, j) for _, i, j in got} == set(full) and len(got) == len(full)
    bounds = [b for b, _, _ in got]
    assert bounds == sorted(bounds, reverse=True) and all(abs(b - one[i] - two[j]) < 1e-12 for b, i, j in got)


def test_products_are_exact():
    big = np.array([[1 << 40, 3], [-(1 << 30), 1 << 62]])
    assert negatives.products(big[:1], np.array([[1 << 20, 7]])).tolist() == [[(1 << 60) + 21]]
    assert negatives.products(big[1:], big[1:]).tolist() == [[(1 << 63) - 1]]
    assert negatives.products(np.array([[3, -4]]), np.array([[5, 6]])).tolist() == [[-9]]


def test_less_than_all_cells_are_read(spark, monkeypatch):
    """Where vectors lie in groups, bounds leave out most cells."""
    monkeypatch.setattr(negatives, "CELL_ROWS", 8)
    draw = np.random.default_rng(5)
    centres = draw.integers(-900, 900, (20, 8))
    rows = [(i, int(draw.integers(0, 3)), (centres[i % 20] + draw.integers(-9, 10, 8)).tolist()) for i in range(2_000)]
    df = spark.createDataFrame(rows, "id long, label long, vector array<long>")
    index = negatives.indexed(df)
    asked = df.filter("id % 100 = 0").select(F.col("id").alias("anchor"), "label", "vector").withColumn("goals", F.expr("array(struct(0L as goal, -1000000000L as low, 1000000000000L as high))"))
    seen = []
    original = negatives.session.materialise
    monkeypatch.setattr(negatives.session, "materialise", lambda d, name: seen.append((name, original(d, name))) or seen[-1][1])
    assert negatives.search(index, asked, 5, True).count() == 100
    visits = sum(d.count() for name, d in seen if name == "visits")
    assert visits < 0.5 * 20 * len(index.codes.full)


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    own = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [int(np.floor(256 * float(x))) for x in r.embedding]) for r in rows]
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    got = entry_points.queries()["op11_negatives"](spark, sf_dir).select(*names).collect()
    assert sorted(tuple(r) for r in got) == plain(own, lambda i: i % 50 == 0)
