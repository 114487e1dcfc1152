"""Hard-negative mining over an inverted multi-index.

Vectors are split into halves, each half has a codebook, and a pair of codewords is a cell.  The score of an anchor
with any row of a cell is at most the sum of two half-scores, each the inner product with the codeword plus the
anchor's length times the codeword's radius.  A multi-sequence heap visits an anchor's cells by that bound, highest first.

A search asks for the best k rows in a window of scores, among rows of the anchor's label or of others.  Rounds visit a
few more cells each; an anchor stops when the next bound is below the k-th score it has in every window, or below
the window, so results are exact whatever the codebooks are.  Positives are one search, and the windows below their
scores, in which negatives lie, another.

Codebooks are fitted on a bounded sample (``SAMPLE`` rows, by a hash of the id); all rows are indexed.  Cells are cut into
blocks of rows and the anchors that visit a cell into blocks of anchors; a pair of blocks is one matrix product, so a cell
with a third of all rows is spread over tasks.  No pair of an anchor and a row becomes a row unless it may be in the result.

Rows with a null id, label or vector, or a null component take no part, nor do those that the caller leaves out.  Rows that
repeat wholly count once; rows of an anchor's id are never its positives or negatives; of several anchors with one id the
first by label and vector asks.  Shorter vectors are filled up with zeros.  Scores beyond 64 bits are cut to their range.
Other columns do not matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder import session
from larder.llm.common import fit_rows

#: Rows from which codebooks are fitted, codewords of a half, rounds of fitting, and rows of a cell that are aimed at.
SAMPLE, MOST_CODES, FIT_ROUNDS, CELL_ROWS = 32_768, 256, 8, 1024
#: Rows and anchors of a block.
BLOCK_ROWS, BLOCK_ANCHORS = 2048, 1024
#: Cells of the first round; each further round visits so many times more.
FIRST_CELLS, MORE = 4, 8
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


@dataclass
class Codebooks:
    """Codewords and radii of both halves, and the cells that hold rows: what a worker needs to order cells."""

    width: int
    books: list[np.ndarray]
    radii: list[np.ndarray]
    full: frozenset[tuple[int, int]]


@dataclass
class Index:
    """Codebooks, the cells with their numbers of blocks, and all rows in blocks by cell."""

    codes: Codebooks
    cells: DataFrame
    packed: DataFrame


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of one width, zeros where they are shorter."""
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def _halves(rows: np.ndarray) -> list[np.ndarray]:
    at = rows.shape[1] // 2
    return [rows[:, :at].astype(float), rows[:, at:].astype(float)]


def _nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(1) - 2 * rows @ book.T).argmin(1)


def fitted(rows: np.ndarray, codes: int) -> np.ndarray:
    """Codewords by k-means, from rows at even places of the sample; a codeword without rows stays."""
    book = rows[np.linspace(0, len(rows) - 1, min(codes, len(rows))).astype(int)].copy()
    for _ in range(FIT_ROUNDS):
        own = _nearest(rows, book)
        n = np.bincount(own, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, own, rows)
        book[n > 0] = sums[n > 0] / n[n > 0, None]
    return book


def _narrowest(rows: np.ndarray) -> np.ndarray:
    most = max(abs(int(rows.min())), abs(int(rows.max()))) if rows.size else 0
    return rows.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8")


def products(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact inner products, cut to 64 bits: by floats while they are exact, by integers of any length else."""
    most = [max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0 for x in (rows, others)]
    if most[0] * most[1] * rows.shape[1] < 1 << 53:
        return (rows.astype(float) @ others.astype(float).T).astype(np.int64)
    exact = rows.astype(object) @ others.astype(object).T
    return np.clip(exact, _LOWEST, _HIGHEST).astype(np.int64)


def indexed(rows: DataFrame) -> Index:
    """The index of rows (id, label, vector array of long), which are written by the caller."""
    n, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = max(width or 0, 2)
    share = int(min(1.0, SAMPLE / max(n, 1)) * (1 << 40))
    # at most SAMPLE vectors come to the driver
    sample = rows.filter(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 40)) <= share).limit(SAMPLE)
    taken = sample.agg(F.collect_list("vector").alias("v")).first()["v"] if n else []
    codes = int(np.clip(round((n / CELL_ROWS) ** 0.5), 1, MOST_CODES))
    halves = _halves(_matrix(pa.array(taken or [[0]], pa.list_(pa.int64())), width))
    books = [fitted(h[np.lexsort(h.T)], codes) for h in halves]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _halves(_matrix(batch.column(2), width))
            at = [_nearest(h, b) for h, b in zip(own, books, strict=True)]
            away = [np.linalg.norm(h - b[a], axis=1) for h, b, a in zip(own, books, at, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(a, pa.int32()) for a in at), *map(pa.array, away)], names=["id", "label", "vector", "one", "two", "d1", "d2"])

    placed = session.materialise(rows.select("id", "label", "vector").mapInArrow(place, "id long, label long, vector array<long>, one int, two int, d1 double, d2 double"), "cells")
    cells = placed.groupBy("one", "two").agg(F.count("*").alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2"))
    cells = session.materialise(cells.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS)), "cells")
    # one row per cell, MOST_CODES squared at most
    known = cells.agg(F.collect_list(F.struct("one", "two", "d1", "d2")).alias("c")).first()["c"]
    radii = [np.zeros(len(b)) for b in books]
    for one, two, d1, d2 in known:
        radii[0][one], radii[1][two] = max(radii[0][one], d1), max(radii[1][two], d2)
    dealt = placed.join(cells.select("one", "two", "blocks"), ["one", "two"])
    dealt = dealt.select("one", "two", F.pmod(F.xxhash64("id", F.lit(12)), "blocks").alias("block"), "id", "label", "vector")
    packed = dealt.groupBy("one", "two", "block").applyInArrow(_packed_rows(width), "one int, two int, block long, ids binary, labels binary, kind string, rows binary")
    return Index(Codebooks(width, books, radii, frozenset((c[0], c[1]) for c in known)), cells.select("one", "two", "blocks"), session.materialise(packed, "cell-blocks"))


def _packed_rows(width: int):
    def run(rows: pa.Table) -> pa.Table:
        own = _narrowest(_matrix(rows["vector"].combine_chunks(), width))
        row = {c: [rows[c][0].as_py()] for c in ("one", "two", "block")}
        row |= {"ids": [rows["id"].to_numpy().astype("<i8").tobytes()], "labels": [rows["label"].to_numpy().astype("<i8").tobytes()], "kind": [own.dtype.str], "rows": [own.tobytes()]}
        return pa.Table.from_pydict(row, schema=pa.schema([("one", pa.int32()), ("two", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("kind", pa.string()), ("rows", pa.binary())]))

    return run


def by_bound(halves: list[np.ndarray], full: frozenset[tuple[int, int]]) -> Iterator[tuple[float, int, int]]:
    """(bound, one, two) of the cells that hold rows, highest bound first: a heap over two descending sequences."""
    orders = [np.argsort(-h, kind="stable").tolist() for h in halves]
    one, two = ([h[i] for i in o] for h, o in zip(halves, orders, strict=True))
    heap, i_of, j_of = [(-(one[0] + two[0]), 0, 0)], orders[0], orders[1]
    while heap:
        bound, i, j = heapq.heappop(heap)
        if (i_of[i], j_of[j]) in full:
            yield -bound, i_of[i], j_of[j]
        # (i, j + 1) is reached from (i, j) alone, (i + 1, 0) from (i, 0)
        if j + 1 < len(two):
            heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(one):
            heapq.heappush(heap, (-(one[i + 1] + two[0]), i + 1, 0))


_GOALS = "array<struct<goal:long,low:long,high:long>>"
_ASKS = f"one int, two int, anchor long, label long, vector array<long>, goals {_GOALS}"


def _visits(codes: Codebooks, done: int, more: int):
    """The cells at places done ... done + more of each anchor's order, as far as they can still change a window's result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = _halves(_matrix(batch.column(2), codes.width))
            least = np.array([min(g["low"] for g in goals) for goals in batch.column(3).to_pylist()], float)
            scores = []
            for rows, book, radius in zip(halves, codes.books, codes.radii, strict=True):
                length = np.linalg.norm(rows, axis=1)[:, None]
                # what rounding may hide is far below this slack
                slack = 1e-9 * length * (np.linalg.norm(book, axis=1) + radius) + 1e-6
                scores.append(rows @ book.T + length * radius + slack)
            take, one, two = [], [], []
            for row in range(len(batch)):
                for place, (bound, i, j) in enumerate(by_bound([scores[0][row], scores[1][row]], codes.full)):
                    if bound < least[row] or place >= done + more:
                        break
                    if place >= done:
                        take.append(row)
                        one.append(i)
                        two.append(j)
            asked = batch.take(pa.array(take, pa.int64()))
            for at in range(0, len(take), 2_000):
                part = asked.slice(at, 2_000)
                yield pa.RecordBatch.from_arrays([pa.array(one[at : at + 2_000], pa.int32()), pa.array(two[at : at + 2_000], pa.int32()), *part.columns], names=["one", "two", "anchor", "label", "vector", "goals"])

    return run


def _packed_anchors(width: int):
    schema = pa.schema([("one", pa.int32()), ("two", pa.int32()), ("blocks", pa.int64()), ("anchors", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("kind", pa.string()), ("rows", pa.binary()), ("goals", pa.list_(pa.list_(pa.struct([("goal", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]))))])

    def run(rows: pa.Table) -> pa.Table:
        own = _narrowest(_matrix(rows["vector"].combine_chunks(), width))
        row = {c: [rows[c][0].as_py()] for c in ("one", "two", "blocks")}
        row |= {"anchors": [rows["anchor"].to_pylist()], "labels": [rows["label"].to_pylist()], "kind": [own.dtype.str], "rows": [own.tobytes()], "goals": [rows["goals"].to_pylist()]}
        return pa.Table.from_pydict(row, schema=schema)

    return run, f"one int, two int, blocks long, anchors array<long>, labels array<long>, kind string, rows binary, goals array<{_GOALS}>"


def _scored(width: int, k: int, same: bool):
    """For a block of rows and a block of anchors: the best k rows in each of an anchor's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                ids, labels = np.frombuffer(pair["ids"], "<i8"), np.frombuffer(pair["row_labels"], "<i8")
                rows = np.frombuffer(pair["row_block"], pair["row_kind"]).reshape(-1, width)
                asking = np.frombuffer(pair["rows"], pair["kind"]).reshape(-1, width)
                scores = products(asking, rows)
                out: list[list[int]] = [[], [], [], []]
                for own, anchor, label, goals in zip(scores, pair["anchors"], pair["labels"], pair["goals"], strict=True):
                    fits = ((labels == label) == same) & (ids != anchor) & (own >= min(g["low"] for g in goals)) & (own <= max(g["high"] for g in goals))
                    places = np.flatnonzero(fits)
                    if not len(places):
                        continue
                    places = places[np.lexsort((ids[places], -own[places]))]
                    ordered = -own[places]
                    for g in goals:
                        a = int(np.searchsorted(ordered, -g["high"], "left"))
                        b = min(a + k, int(np.searchsorted(ordered, -g["low"], "right")))
                        if a < b:
                            out[0] += [anchor] * (b - a)
                            out[1] += [g["goal"]] * (b - a)
                            out[2] += ids[places[a:b]].tolist()
                            out[3] += own[places[a:b]].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["anchor", "goal", "id", "score"])

    return run


def search(index: Index, asked: DataFrame, k: int, same_label: bool) -> DataFrame:
    """(anchor, goal, id, score, rank): for each window of an anchor the first k rows by score, then id.

    ``asked`` has (anchor, label, vector, goals), a goal being (goal, low, high): a number and the window's ends, both within.
    """
    spark = asked.sparkSession
    asked = session.materialise(asked, "asked")
    salts = fit_rows(asked.count(), BLOCK_ANCHORS)
    pack, packed_schema = _packed_anchors(index.codes.width)
    order = Window.partitionBy("anchor", "goal").orderBy(F.desc("score"), "id")
    best = spark.createDataFrame([], "anchor long, goal long, id long, score long, rank int")
    done, more = 0, FIRST_CELLS
    while True:
        # a window that has k rows needs no score below the last of them
        floors = best.filter(F.col("rank") == k).select(F.col("anchor").alias("a"), F.col("goal").alias("g"), F.col("score").alias("kth"))
        goals = asked.select("anchor", F.explode("goals").alias("w")).join(floors, (F.col("anchor") == F.col("a")) & (F.col("w.goal") == F.col("g")), "left")
        goals = goals.groupBy(F.col("anchor").alias("a")).agg(F.collect_list(F.struct(F.col("w.goal").alias("goal"), F.greatest("w.low", "kth").alias("low"), F.col("w.high").alias("high"))).alias("left"))
        state = asked.join(goals, F.col("anchor") == F.col("a")).select("anchor", "label", "vector", F.col("left").alias("goals"))
        asks = session.materialise(state.mapInArrow(_visits(index.codes, done, more), _ASKS), "visits")
        if asks.first() is None:
            return best
        dealt = asks.join(index.cells, ["one", "two"]).withColumn("salt", F.pmod(F.xxhash64("anchor", F.lit(13)), F.lit(salts)))
        queries = dealt.groupBy("one", "two", "salt").applyInArrow(pack, packed_schema)
        queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
        rows = index.packed.select("one", "two", "block", "ids", F.col("labels").alias("row_labels"), F.col("kind").alias("row_kind"), F.col("rows").alias("row_block"))
        found = queries.join(rows, ["one", "two", "block"]).mapInArrow(_scored(index.codes.width, k, same_label), "anchor long, goal long, id long, score long")
        both = best.drop("rank").union(found)
        best = session.materialise(both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "best")
        done, more = done + more, more * MORE


def _hundredths(score: Column, share: int) -> Column:
    """``share`` hundredths of a score, exactly."""
    return score.cast("decimal(20,0)") * F.lit(share) / F.lit(100)


def mined(
    df: DataFrame,
    anchor: Column,
    id: str = "id",
    label: str = "label",
    vector: str = "vector",
    positives: int = 5,
    negatives: int = 3,
    between: tuple[int, int] = (50, 95),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For rows where ``anchor`` holds and each of their first ``positives`` rows of the same label: the first ``negatives`` rows
    of other labels whose score is ``between`` so many hundredths of the positive's.  Vectors and labels are whole numbers.
    """
    whole = F.col(id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull())
    rows = df.filter(whole).select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<long>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("asks"))
    rows = session.materialise(rows.groupBy("id", "label", "vector").agg(F.max("asks").alias("asks")), "vectors")
    index = indexed(rows)
    first = F.min(F.struct("label", "vector")).alias("first")
    anchors = rows.filter("asks").groupBy(F.col("id").alias("anchor")).agg(first).select("anchor", "first.label", "first.vector")
    anchors = session.materialise(anchors, "anchors")
    goal = lambda g, low, high: F.struct(g.cast("long").alias("goal"), low.cast("long").alias("low"), high.cast("long").alias("high"))
    everything = F.array(goal(F.lit(0), F.lit(_LOWEST + 1), F.lit(_HIGHEST)))
    liked = search(index, anchors.withColumn("goals", everything), positives, True)
    low, high = (_hundredths(F.col("score"), share) for share in between)
    windows = liked.select("anchor", goal(F.col("id"), F.ceil(low), F.floor(high)).alias("w")).filter("w.low <= w.high")
    windows = windows.groupBy("anchor").agg(F.collect_list("w").alias("goals"))
    disliked = search(index, anchors.join(windows, "anchor"), negatives, False)
    named = liked.select(F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    at = (F.col("anchor_id") == F.col("anchor")) & (F.col("positive_id") == F.col("goal"))
    return named.join(disliked, at).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    rows = rows.filter(finite).select("vec_id", label.alias("label"), vector.alias("vector"))
    return mined(rows, F.col("vec_id") % 50 == 0, id="vec_id")


QUERIES = {"op11_negatives": _query}
SQL = {
    "op11_negatives": """
        with rows as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scores as (
            select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
            from rows a join rows b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
        ), positives as (
            select anchor_id, id as positive_id, score as positive_score from scores where same
            qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
        ), negatives as (
            select anchor_id, positive_id, id as negative_id, positive_score, score as negative_score,
                   row_number() over (partition by anchor_id, positive_id order by score desc, id) as rank
            from positives join scores using (anchor_id)
            where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        )
        select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from negatives where rank <= 3
    """,
}
