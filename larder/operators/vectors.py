"""Text vectors and nearest neighbours by inner product.

The search cuts items and queries into blocks of bounded size and scores one
block pair per task by matrix products of slices, keeping the k best per query.  Nothing
is broadcast and no pair of vectors becomes a row.  ``vector_index`` has a stored index.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import vectors
from larder.operators import aggregates, joins, ranking

# A factory that runs once per Python worker, loads a model there and returns
# the function from a batch of texts to a matrix of vectors.
EncoderFactory = Callable[[], Callable[[np.ndarray], np.ndarray]]

VECTOR = T.ArrayType(T.FloatType())

#: Length of the vectors made without a model.
DIMENSIONS = 64


def embed_text(
    df: DataFrame,
    keys: Sequence[str],
    fields: Mapping[str, str],
    encoder: EncoderFactory | None = None,
    batch_size: int = 256,
    spread: int | None = None,
) -> DataFrame:
    """Vectors of text fields: ``fields`` maps a text column to its vector column.

    Without an encoder the vectors are hashed token counts of length 1, made by
    built-in functions.  Encoding with a model outweighs moving the text, so with
    ``spread`` the rows are first dealt out by key to that many tasks, whatever
    the layout of the files.
    """
    if encoder is None:
        return _dense(_token_values(df, keys, fields), ["__row", *keys], fields).drop("__row")
    if spread:
        df = df.select(*keys, *fields).repartition(spread, *keys)
    encode = predict_batch_udf(encoder, return_type=VECTOR, batch_size=batch_size)
    # A filter on the vector must not make Spark encode a second time below it.
    encode = encode.asNondeterministic()
    return df.select(*keys, *[encode(F.coalesce(F.col(t), F.lit(""))).alias(v) for t, v in fields.items()])


def _token_values(df: DataFrame, keys: Sequence[str], fields: Mapping[str, str]) -> DataFrame:
    """(__row, keys, field, place, value): the elements other than 0 of each row's vectors; place is null where there are none.

    Tokens become rows and are counted by place, at most ``DIMENSIONS`` of them for each row and field before anything is
    shuffled: a row's tokens lie in one task.
    """
    rows = df.select(F.monotonically_increasing_id().alias("__row"), *keys, *fields)
    texts = [F.struct(F.lit(n).alias("field"), F.col(t).alias("text")) for n, t in enumerate(fields)]
    single = rows.select("__row", *keys, F.explode(F.array(*texts)).alias("__f"))
    words = single.select("__row", *keys, F.col("__f.field").alias("field"), F.explode_outer(vectors.tokens("__f.text")).alias("token"))
    own = ["__row", *keys, "field"]
    counts = words.groupBy(*own, vectors.token_place("token", DIMENSIONS).alias("place")).agg(F.count("token").alias("n"))
    lengths = counts.groupBy(*own).agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("length"), F.collect_list(F.struct("place", "n")).alias("all"))
    single = lengths.select(*own, "length", F.explode("all").alias("e"))
    value = (F.col("e.n") / F.col("length")).cast("float").cast("double")
    return single.select(*own, F.col("e.place").alias("place"), F.when(F.col("e.place").isNotNull(), value).alias("value"))


def _dense(values: DataFrame, keys: Sequence[str], fields: Mapping[str, str], kind: str = "float") -> DataFrame:
    """One row per key with a vector for each field, from its elements."""
    own = lambda n: F.when((F.col("field") == n) & F.col("place").isNotNull(), F.struct("place", "value"))
    gathered = [F.collect_list(own(n)).alias(v) for n, v in enumerate(fields.values())]
    made = values.groupBy(*keys).agg(*gathered)
    return made.select(*keys, *[vectors.densified(v, DIMENSIONS, kind).alias(v) for v in fields.values()])


def _token_means(df: DataFrame, keys: Sequence[str], text: str, out: str) -> DataFrame:
    """Mean of the default vectors per key, summed by (key, place)."""
    values = _token_values(df, keys, {text: out})
    sums = values.filter("place is not null").groupBy(*keys, "place").agg(F.sum("value").alias("total"))
    sizes = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.count("*").alias("__n"))
    same = [F.col(f"__{k}").eqNullSafe(F.col(k)) for k in keys]
    whole = sizes.join(sums, same, "left").withColumns({"field": F.lit(0), "value": F.col("total") / F.col("__n")})
    made = _dense(whole, [f"__{k}" for k in keys], {text: out}, "double")
    return made.withColumnsRenamed({f"__{k}": k for k in keys})


def history_vectors(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    encoder: EncoderFactory | None = None,
    batch_size: int = 16,
    out: str = "vector",
    spread_by: Sequence[str] = (),
    spread: int | None = None,
) -> DataFrame:
    """Mean vector over all texts of a key.

    Texts are dealt out by ``spread_by``, which is finer than the key, so the
    texts of one key are encoded by many tasks; their sums meet afterwards.  Default vectors are summed element by
    element and made dense at the end.
    """
    if encoder is None:
        return _token_means(df, keys, text, out)
    columns = list(dict.fromkeys([*keys, *spread_by]))
    rows = df.select(*columns, text)
    if spread and encoder is not None:
        rows = rows.repartition(spread, *(spread_by or keys))
    return aggregates.vector_mean(embed_text(rows, columns, {text: "__text"}, encoder, batch_size), keys, "__text", out)


def merge_vectors(
    initial: DataFrame, history: DataFrame, key: str, category: Sequence[str], vector: str = "vector", out: str = "vector"
) -> DataFrame:
    """Mean of initial and history vector per id, or the initial one alone.

    One pass over all categories; adds the sequential id ``vid`` per category.
    """
    past = history.select(key, *category, F.col(vector).alias("__past"))
    joined = initial.join(past, [key, *category], "left")
    merged = joined.withColumn(out, vectors.pair_mean(vector, "__past")).select(key, *category, out)
    return ranking.dense_ids(merged, key, category)


# --- search ---------------------------------------------------------------

_RESULT = T.StructType(
    [T.StructField("__q", T.StringType()), T.StructField("__i", T.StringType()), T.StructField("score", T.DoubleType())]
)


#: Values of a block of vectors that one task reads of each side, and rows of the two sides that are multiplied at a time.
BLOCK_VALUES, QUERY_ROWS, ITEM_ROWS = 1 << 21, 256, 4096
#: Blocks into which a smaller table of items is cut, so that several tasks compare it, if each has so many values.
ITEM_BLOCKS, LEAST_VALUES = 8, 1 << 18


def in_order(names: np.ndarray, matrix: np.ndarray, k: int) -> np.ndarray:
    """Places of the items by name, of equal vectors the first ``k`` only: no other copy can be among the k best."""
    order = np.argsort(names, kind="stable")
    if not matrix.shape[1]:
        return order[:k]
    raw = np.ascontiguousarray(matrix[order]).view(np.dtype((np.void, matrix.itemsize * matrix.shape[1])))[:, 0]
    _, first, vector = np.unique(raw, return_index=True, return_inverse=True)
    if len(first) == len(order):
        return order
    by_vector = np.argsort(vector, kind="stable")
    sizes = np.bincount(vector)
    place = np.empty(len(order), np.int64)
    place[by_vector] = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return order[place < k]


def best_of(owner: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each owner, ties by item, sorted by owner and place."""
    order = np.lexsort((item, -score, owner))
    owner, item, score = owner[order], item[order], score[order]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    return owner[place < k], item[place < k], score[place < k]


def best_products(
    asking: np.ndarray, matrix: np.ndarray, k: int, floors: np.ndarray | None = None, wanted: Callable[[int, int], np.ndarray] | None = None, item_rows: int = ITEM_ROWS, query_rows: int = QUERY_ROWS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, item, score) by places: the k best items of each query; equal scores go to the item that comes first.

    Slices of both sides are multiplied, so memory does not grow with a block.  The product finds the items within rounding
    of the k-th score so far, or of a floor that is known.  Only those are scored again, element by element in a fixed
    order, so that equal vectors score equally wherever they lie.  ``wanted(begin, end)`` gives, for a slice of the queries,
    which items they ask for (queries x items); the others are left out.
    """
    out = []
    longest = np.linalg.norm(matrix, axis=1).max() if len(matrix) else 0.0
    for at in range(0, len(asking), query_rows):
        part = asking[at : at + query_rows]
        margin = 1e-9 * longest * np.linalg.norm(part, axis=1)
        least = np.full(len(part), -np.inf) if floors is None else floors[at : at + query_rows] - 1e-9 * (np.abs(floors[at : at + query_rows]) + 1)
        least[np.isnan(least)] = -np.inf
        asked = wanted(at, at + len(part)) if wanted else None
        places = np.arange(len(matrix)) if asked is None else np.flatnonzero(asked.any(axis=0))
        found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for begin in range(0, len(places), item_rows):
            own = places[begin : begin + item_rows]
            items = matrix[own]
            scores = part @ items.T
            if asked is not None:
                scores[~asked[:, own]] = -np.inf
            scores[np.isnan(scores)] = -np.inf
            lowest = least
            if np.isneginf(least).any():
                kept = min(k, len(own))
                lowest = np.maximum(least, np.partition(scores, len(own) - kept, axis=1)[:, len(own) - kept])
            row, column = np.nonzero((scores >= (lowest - margin)[:, None]) & (scores > -np.inf))
            exact = [(items[column[i : i + 65_536]] * part[row[i : i + 65_536]]).sum(axis=1) for i in range(0, len(row), 65_536)]
            found = best_of(*(np.concatenate(x) for x in zip(found, (row, own[column], np.concatenate([np.zeros(0), *exact])), strict=True)), k)
            full = np.flatnonzero(np.bincount(found[0], minlength=len(part)) == k)
            last = np.searchsorted(found[0], full, "right") - 1
            least[full] = np.maximum(least[full], found[2][last])
        out.append((found[0] + at, found[1], found[2]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _block_top_k(k: int, item_rows: int, query_rows: int):
    """Score one block pair and keep the k best items per query."""

    def search(queries: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or items.empty:
            return pd.DataFrame({"__q": [], "__i": [], "score": []}).astype({"__q": object, "__i": object, "score": float})
        names, matrix = items["__i"].to_numpy(), np.stack(items["__v"].to_numpy()).astype(np.float64)
        order = in_order(names, matrix, k)
        asking = np.stack(queries["__v"].to_numpy()).astype(np.float64)
        owner, item, score = best_products(asking, matrix[order], k, item_rows=item_rows, query_rows=query_rows)
        return pd.DataFrame({"__q": queries["__q"].to_numpy()[owner], "__i": names[order][item], "score": score})

    return search


def _blocks(df: DataFrame, least: int = 1):
    """Number of blocks for a table, as a scalar of the plan; ``least`` or as many as have ``LEAST_VALUES``."""
    values = F.coalesce(F.sum(F.size("__v")), F.lit(0))
    rows = df.agg(F.greatest(F.lit(1), F.ceil(values / (2 * BLOCK_VALUES)), F.least(F.lit(least), F.ceil(values / LEAST_VALUES))).cast("int").alias("blocks"))
    return rows.scalar()


def _search(queries: DataFrame, items: DataFrame, block: Sequence[str], k: int, out: Sequence[str], item_rows: int, query_rows: int) -> DataFrame:
    found = queries.groupBy(*block).cogroup(items.groupBy(*block)).applyInPandas(_block_top_k(k, item_rows, query_rows), _RESULT)
    ranked = ranking.rank_within(found, ["__q"], [F.col("score").desc(), F.col("__i")], k)
    return ranked.select(F.col("__q").alias(out[0]), F.col("__i").alias(out[1]), "score", "rank")


def _keyed(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias(name), F.col(vector).alias("__v")).filter("__v is not null")


def knn_inner_product(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    query_key: str,
    item_key: str,
    vector: str = "vector",
    out: Sequence[str] = ("query", "item"),
    block_rows: int = 65_536,
    query_rows: int = 4_096,
) -> DataFrame:
    """Exact k best items per query: (query, item, score, rank).

    Ids are returned as text; ties go to the smaller one.  Items are copied once
    per block of queries and queries once per block of items, so the shuffle
    grows with items x query blocks, never with the number of pairs.  A block has
    at most twice ``BLOCK_VALUES`` values whatever the rows asked for: ``block_rows`` and ``query_rows``
    bound what is multiplied at a time.
    """
    q, i = _keyed(queries, query_key, vector, "__q"), _keyed(items, item_key, vector, "__i")
    item_blocks, query_blocks = _blocks(i, ITEM_BLOCKS), _blocks(q)

    def own(name: str, blocks):
        return F.pmod(F.xxhash64(name), blocks.cast("bigint")).cast("int")

    def every(blocks):
        return F.explode(F.sequence(F.lit(0), blocks - 1))

    placed_q = q.withColumn("__qb", own("__q", query_blocks)).withColumn("__ib", every(item_blocks))
    placed_i = i.withColumn("__ib", own("__i", item_blocks)).withColumn("__qb", every(query_blocks))
    return _search(placed_q, placed_i, ["__qb", "__ib"], k, out, min(block_rows, ITEM_ROWS), min(query_rows, QUERY_ROWS))


def recall(found: DataFrame, truth: DataFrame, query: str = "query", item: str = "item") -> DataFrame:
    """One row: the share of the true neighbours that were found."""
    hits = truth.select(query, item).join(found.select(query, item).withColumn("hit", F.lit(1)), [query, item], "left")
    return hits.agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


def lookup_vectors(
    df: DataFrame,
    adhoc: DataFrame,
    static: DataFrame,
    id_key: str,
    static_keys: Sequence[str],
    adhoc_vector: str,
    static_vector: str,
    unique: bool = False,
) -> DataFrame:
    """Attach the vector of the row's id and that of its reference and category.

    Say ``unique`` where both tables have one vector per key.
    """
    rows = joins.lookup(df, adhoc, {id_key: id_key}, {adhoc_vector: "adhoc_vector"}, unique)
    return joins.lookup(rows, static, {c: c for c in static_keys}, {static_vector: "static_vector"}, unique)

