"""Vectors, neighbours, the ranking model, streams."""

from __future__ import annotations

import hashlib
import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from support import rows
from pyspark.sql import functions as F

from catalog import model_queries, table
from larder import session
from larder.operators import model, vector_index, vectors
from larder.sources import snapshots
from larder.sources.serving import ServingTable
from larder.streaming import incremental


def points(spark, n, dim=8, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    data = [(i, [float(x) for x in rng.normal(size=dim)]) for i in range(n)]
    data += [(n + i, data[0][1]) for i in range(copies)]
    return spark.createDataFrame(data, "id int, vector array<float>")


def brute_force(queries, items, k):
    q = {str(r["id"]): np.array(r["vector"]) for r in queries.collect()}
    i = {str(r["id"]): np.array(r["vector"]) for r in items.collect()}
    return {
        (name, item, rank + 1)
        for name, v in q.items()
        for rank, item in enumerate(sorted(i, key=lambda n: (-round(float(v @ i[n]), 9), n))[:k])
    }


@pytest.mark.parametrize(("block_rows", "query_rows"), [(65_536, 4_096), (30, 7), (1000, 5)])
def test_exact_neighbours(spark, block_rows, query_rows):
    items, queries = points(spark, 200), points(spark, 23, seed=2)
    got = vectors.knn_inner_product(queries, items, 5, "id", "id", block_rows=block_rows, query_rows=query_rows)
    assert {(r["query"], r["item"], r["rank"]) for r in got.collect()} == brute_force(queries, items, 5)


def test_more_neighbours_than_items(spark):
    got = vectors.knn_inner_product(points(spark, 2, seed=2), points(spark, 3), 10, "id", "id")
    assert got.count() == 6


def test_index_searches(spark, root):
    """Exact search equals brute force, ties and blocks included; the approximate one finds most of it."""
    items, queries = points(spark, 400, copies=200), points(spark, 20, seed=2)
    index = vector_index.VectorIndex(spark, root).build(items, "id", cells=8)
    exact = vectors.knn_inner_product(queries, items, 5, "id", "id")
    rounded = lambda df: rows(df.select("query", "item", F.round("score", 9).alias("score"), "rank"))
    assert rounded(index.search_exact(queries, 5, "id", block_rows=50, query_rows=7)) == rounded(exact)
    assert vectors.recall(index.search(queries, 5, "id", share=0.8), exact).first()["recall"] > 0.7
    none = items.filter("id < 0")
    empty = vector_index.VectorIndex(spark, f"{root}/empty").build(none, "id")
    assert empty.search_exact(queries, 5, "id").count() == 0 and empty.search(queries, 5, "id").count() == 0


def test_longest_items_come_first(spark, root):
    """Of vectors of mixed length few cells are near a query, and those hold its neighbours."""
    rng = np.random.default_rng(3)
    data = [(i, (rng.normal(size=8) * (1 + i % 9)).tolist()) for i in range(900)]
    items = spark.createDataFrame(data, "id int, vector array<double>")
    queries = items.filter("id % 30 = 0")
    index = vector_index.VectorIndex(spark, root).build(items, "id")
    truth = vectors.knn_inner_product(queries, items, 10, "id", "id")
    assert vectors.recall(index.search(queries, 10, "id"), truth).first()["recall"] >= 0.9
    read = index.probe(queries, "id").join(spark.read.parquet(f"{root}/cells"), "cell").agg(F.sum("n")).first()[0]
    assert read < 0.25 * 900 * 30


def test_approximate_search_writes_blocks(spark, root, monkeypatch):
    """A query stands once for each block that it reads, not for each cell; what is stored already is not stored again."""
    seen, original = {}, session.materialise
    monkeypatch.setattr(vector_index.session, "materialise", lambda d, n: seen.setdefault(n, original(d, n)))
    rng = np.random.default_rng(3)
    data = [(i, (rng.normal(size=8) * (1 + i % 9)).tolist()) for i in range(900)]
    items = original(spark.createDataFrame(data, "id int, vector array<double>"), "given")
    index = vector_index.VectorIndex(spark, root).build(items, "id")
    assert "index-items" not in seen and items.count() == 900
    queries = items.filter("id % 30 = 0")
    assert index.search(queries, 10, "id", block_rows=10, query_rows=3).count() == 300
    assert seen["routed"].count() == 30 and index.probe(queries, "id").count() > 10 * 30
    assert seen["candidates"].count() == 30


@pytest.mark.parametrize("rows_asked", [(65_536, 4_096), (7, 3)])
def test_blocks_of_codes_hold_all(spark, root, monkeypatch, rows_asked):
    """With all cells read and as many candidates as items nothing is left out, whatever the blocks; so with copies of a vector."""
    for name, value in {"CODED_ROWS": 16, "LEAST_CODED": 8, "ASKING_ROWS": 5, "LEAST_ASKING": 2, "BLOCK_VALUES": 8 * 6}.items():
        monkeypatch.setattr(vector_index, name, value)
    items, queries = points(spark, 50, copies=30), points(spark, 23, seed=2)
    index = vector_index.VectorIndex(spark, root).build(items, "id", cells=6)
    got = index.search(queries, 10, "id", share=1.0, block_rows=rows_asked[0], query_rows=rows_asked[1])
    assert {(r["query"], r["item"], r["rank"]) for r in got.collect()} == brute_force(queries, items, 10)


def test_named_pairs_are_scored():
    """A null element or one that the other lacks adds nothing; an id may stand for several items, or for none of the block."""
    lists = lambda *x: pa.array(x, pa.list_(pa.float64()))
    queries = pa.table({"__q": ["a", "b"], "v": lists([1.0, 2.0, 4.0], [3.0, None]), "items": [["y", "x", "z"], ["x"]]})
    items = pa.table({"__i": ["x", "w", "y", "x"], "v": lists([1.0, 1.0], [9.0, 9.0], [None, 0.5], [2.0, 1.0])})
    found = vector_index._scored_pairs(2)(queries, items).to_pylist()
    assert sorted((r["__q"], r["__i"], r["score"]) for r in found) == [("a", "x", 3.0), ("a", "x", 4.0), ("a", "y", 1.0), ("b", "x", 3.0), ("b", "x", 6.0)]


def test_bounds_leave_cells_out(spark, root, monkeypatch):
    """All against all of grouped vectors: what is asked of cells grows less than the pairs do."""
    rng, asked = np.random.default_rng(5), []
    original = vector_index.session.materialise
    monkeypatch.setattr(vector_index.session, "materialise", lambda d, n: (f := original(d, n), n == "visits" and seen.append(f))[0])
    for n in (400, 1600):
        centres = rng.normal(size=(n // 40, 8)) * 10
        data = [(i, (centres[i % len(centres)] + rng.normal(size=8) / 10).tolist()) for i in range(n)]
        items, seen = spark.createDataFrame(data, "id int, vector array<double>"), []
        index = vector_index.VectorIndex(spark, f"{root}/{n}").build(items, "id")
        got = index.search_exact(items, 3, "id")
        assert {(r["query"], r["item"], r["rank"]) for r in got.collect()} == brute_force(items, items, 3)
        sizes = spark.read.parquet(f"{root}/{n}/cells")
        asked.append(sum(f.join(sizes, "cell").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for f in seen))
    assert asked[0] < 0.4 * 400**2 and asked[1] < 8 * asked[0]

def test_blocks_of_cells_hold_all(spark, root, monkeypatch):
    """Blocks smaller than a cell, and batches that write no row for each pair of a query and a cell."""
    monkeypatch.setattr(vector_index, "BLOCK_VALUES", 8 * 60)
    monkeypatch.setattr(vectors, "BLOCK_VALUES", 8 * 60)
    items = points(spark, 300, dim=8, copies=150)
    index = vector_index.VectorIndex(spark, root).build(items, "id", cells=40)
    got = index.search_exact(items, 3, "id", block_rows=50, query_rows=7)
    assert {(r["query"], r["item"], r["rank"]) for r in got.collect()} == brute_force(items, items, 3)
    got = vectors.knn_inner_product(items, items, 3, "id", "id", block_rows=50, query_rows=7)
    assert {(r["query"], r["item"], r["rank"]) for r in got.collect()} == brute_force(items, items, 3)


def test_slices_bound_what_a_worker_holds():
    """Vectors without groups: batches of any number of queries leave no batch for every pair with a cell."""
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(5000, 4))
    centres = np.concatenate([rows[:500], np.zeros((500, 1))], axis=1)
    full = np.ones(500)
    books = vector_index.Codebooks(10.0, centres, [], full, full * 100, full)
    batch = pa.RecordBatch.from_arrays([pa.array(rows.tolist()), pa.array([[0, 1]] * 5000, pa.list_(pa.int32())), pa.array([0.0] * 5000), pa.array(np.arange(5000) % 2), pa.array([0] * 5000, pa.int32())], names=["v", "first", "floor", "qblock", "home"])
    made = list(vector_index._asked(books)(iter([batch])))
    assert sum(len(b) for b in made) == 20 * 2 * 498  # for each slice of 256 queries, not for each query
    asking = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(5000)]), batch.column(0)], names=["__q", "v"])
    made = list(vector_index._first_cells(books)(iter([asking])))
    assert max(len(b) for b in made) <= vector_index.ROWS_AT_ONCE and sum(len(b) for b in made) == 5000


def test_equal_vectors_weigh_little():
    """Of many copies only the first k by name are scored."""
    names = np.array([str(i) for i in range(1000)], dtype=object)
    matrix = np.ones((1000, 3))
    matrix[7] = 2
    assert vectors.in_order(names, matrix, 3).tolist() == [0, 1, 10, 7]


def test_default_encoder(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (4, "b  a\ta")], "id int, t string")
    got = {r["id"]: r["v"] for r in vectors.embed_text(df, ["id"], {"t": "v"}).collect()}
    assert np.linalg.norm(got[1]) == pytest.approx(1, abs=1e-6) and got[1] == got[4]
    assert set(got[2]) == set(got[3]) == {0.0}
    dealt = vectors.embed_text(df, ["id"], {"t": "v"}, spread=5)
    assert {r["id"]: r["v"] for r in dealt.collect()} == got


def test_default_vectors_by_hand(spark):
    texts = ["a b a", "é\u00a0x y\tz", " ", "w " * 500 + "v"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in vectors.embed_text(df, ["id"], {"t": "v"}).collect():
        counts = np.zeros(64)
        for word in re.findall("[^ \t\n\r\f\v]+", texts[r["id"]]):
            counts[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 64] += 1
        assert r["v"] == pytest.approx((counts / max(np.linalg.norm(counts), 1e-9)).tolist(), abs=1e-6)


def test_texts_are_encoded_once(spark, sf_dir):
    """A filter on the vectors must not repeat the encoder below the shuffle."""

    def ones():
        return lambda texts: np.ones((len(texts), 2), dtype=np.float32)

    docs = table(spark, sf_dir, "documents")
    made = vectors.embed_text(docs, ["doc_id"], {"text": "v"}, ones, spread=4).select("doc_id", F.explode("v").alias("x")).filter("x > 0")
    assert made._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_own_encoder_and_history(spark):
    def lengths():
        def encode(texts):
            return np.array([[len(t or ""), 1.0] for t in texts], dtype=np.float32)

        return encode

    df = spark.createDataFrame([("x", 1, "aa"), ("x", 2, "aaaa"), ("y", 3, "")], "k string, i int, t string")
    got = vectors.history_vectors(df, ["k"], "t", lengths, spread_by=["i"], spread=3)
    assert rows(got) == [("x", [3.0, 1.0]), ("y", [0.0, 1.0])]


# --- model ----------------------------------------------------------------


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    judged = model_queries.judged_documents(spark, sf_dir)
    path = snapshots.write_parquet(judged, session.scratch_path(spark, "judged"))
    judged = spark.read.parquet(path)
    return judged, model.train_ranker(judged, model_queries.FEATURES, "quality", trees=4)


def test_scores_and_threshold(trained):
    judged, fitted = trained
    scored = model.score_batch(fitted, judged, model_queries.FEATURES, threshold=0.7)
    assert scored.columns[: len(judged.columns)] == judged.columns
    assert scored.filter("probability < 0 or probability > 1").count() == 0
    assert scored.filter("prediction <> cast(probability > 0.7 as int)").count() == 0
    metrics = model.evaluate_scores(scored, "quality").first()
    assert metrics["f1"] > 0.8 and metrics["n"] == judged.count()


def test_training_refuses_nulls(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 0)], "x double, y int")
    with pytest.raises(ValueError, match="x"):
        model.train_ranker(df, ["x"], "y", trees=1)


def expected_value(tree, row, known, node=0):
    """Value of a tree when only some features of a row are known."""
    here = tree[node]
    if here.left < 0:
        return here.value
    left, right = (expected_value(tree, row, known, child) for child in (here.left, here.right))
    if here.feature in known:
        return left if row[here.feature] <= here.threshold else right
    return (left * tree[here.left].rows + right * tree[here.right].rows) / here.rows


def test_shapley_values_by_brute_force(trained):
    judged, fitted = trained
    names = model_queries.FEATURES
    trees = [{n.node: n for n in t.itertuples()} for _, t in model.tree_nodes(fitted).groupby("tree")]
    data = judged.limit(5).select("doc_id", *names).collect()
    got = {r["doc_id"]: r for r in model.explain_rows(fitted, judged, names, ["doc_id"]).collect()}
    n = len(names)
    for record in data:
        row = [float(record[f]) for f in names]
        worth = {
            known: sum(expected_value(t, row, known) for t in trees)
            for size in range(n + 1)
            for known in map(frozenset, itertools.combinations(range(n), size))
        }
        for i, name in enumerate(names):
            value = sum(
                math.factorial(len(k)) * math.factorial(n - len(k) - 1) / math.factorial(n) * (worth[k | {i}] - worth[k])
                for k in worth
                if i not in k
            )
            assert got[record["doc_id"]][name] == pytest.approx(value, abs=1e-9)


def test_values_and_interactions_add_up(trained):
    judged, fitted = trained
    names = model_queries.FEATURES
    trees = [{n.node: n for n in t.itertuples()} for _, t in model.tree_nodes(fitted).groupby("tree")]
    base = sum(expected_value(t, [0.0] * len(names), frozenset()) for t in trees)
    parts = model.attributions(fitted, judged, names)
    single = {r["feature"]: r["mean"] for r in parts.filter("other is null").collect()}
    paired = {r["feature"]: r["m"] for r in parts.filter("other is not null").groupBy("feature").agg(F.sum("mean").alias("m")).collect()}
    assert paired == pytest.approx(single)
    scored = model.score_batch(fitted, judged, names)
    margin = scored.agg(F.avg(F.log(F.col("probability") / (1 - F.col("probability"))) / 2)).first()[0]
    assert sum(single.values()) + base == pytest.approx(margin, abs=1e-6)
    one, two = (parts.filter(f"feature = '{a}' and other = '{b}'").first()["mean"] for a, b in (names[:2], names[1::-1]))
    assert one == pytest.approx(two)
    sampled = model.explain_features(fitted, judged, names, ["doc_id"], n_sample=20)
    assert sampled.count() == len(names) ** 2 + len(names)


@pytest.mark.parametrize("most", [1, 40, 1 << 15])
def test_tables_stand_for_leaves(trained, monkeypatch, most):
    """Tables of any size give what the leaves give one by one, also at thresholds and for what is no number."""
    _, fitted = trained
    found, count = model.leaves(model.tree_nodes(fitted)), len(model_queries.FEATURES)
    monkeypatch.setattr(model, "TABLE_VALUES", most)
    edges = [[e for leaf in found for f, *ends in zip(leaf.players, leaf.low, leaf.high) if f == g for e in ends if math.isfinite(e)] or [0.0] for g in range(count)]
    rng = np.random.default_rng(4)
    x = np.stack([rng.choice([*e, max(e) + 1, min(e) - 1], 300) for e in edges], axis=1)
    x[0], x[1, 0] = np.nan, np.nan
    values, mixed = model.ShapleyTables(found, count, True).explain(x)
    alone, none = model.ShapleyTables(found, count, False).explain(x)
    assert none is None and len(model.ShapleyTables(found, count, False).tables) <= len(found)
    want = np.zeros((300, count))
    pairs = np.zeros((300, count, count))
    for leaf in found:
        own, both = model._of_leaf(leaf, model._passed(leaf, x).astype(float), True)
        for i, f in enumerate(leaf.players):
            want[:, f] += own[i]
            for j, g in enumerate(leaf.players):
                pairs[:, f, g] += both[i, j]
    pairs[:, np.arange(count), np.arange(count)] = want - pairs.sum(axis=2)
    assert np.allclose(values, want) and np.allclose(alone, want) and np.allclose(mixed, pairs)


def test_permutation_importance(trained):
    judged, fitted = trained
    got = {r["feature"]: r["f1_drop"] for r in model.permutation_importance(fitted, judged, model_queries.FEATURES, "quality", "doc_id").collect()}
    assert set(got) == set(model_queries.FEATURES) and max(got.values()) > 0


def test_leaderboard(spark):
    made = spark.createDataFrame(
        [(0.5, 0.5, None), (0.9, 0.9, 0.3), (0.0, 0.4, 0.5)], "precision double, recall double, threshold double"
    ).withColumn("name", F.concat(F.lit("run"), F.col("precision").cast("string")))
    new = model.run_record(made, F.lit('{"start_time": "t0"}'), ["m1", "m2"], {"task_name": F.lit("t"), "domain_name": F.col("name")})
    none = spark.createDataFrame([], "record_id bigint, snapshots string, models string, evaluations string, task_name string, domain_name string")
    records = model.append_records(none, new, ["domain_name"])
    records = model.append_records(records, new, ["domain_name"])
    assert sorted(r["record_id"] for r in records.collect()) == [1, 2, 3, 4, 5, 6]
    best = model.leaderboard(records, 4).collect()
    assert [r["domain_name"] for r in best] == ["run0.9", "run0.9", "run0.5", "run0.5"]
    assert best[0]["precision"] == "0.900" and best[0]["threshold"] == "0.300" and best[2]["threshold"] == "0.500"
    assert best[0]["model_name"] == "m1|m2" and best[0]["record_time"] == "t0" and best[0]["f1"] == pytest.approx(0.9)


# --- streams --------------------------------------------------------------


@pytest.mark.parametrize("files", [1, 3, 7])
@pytest.mark.parametrize("order", ["ts", "ts desc"])
def test_stream_equals_batch_for_any_files(spark, sf_dir, root, files, order):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    events.repartitionByRange(files, F.expr(order.split()[0]) if "desc" not in order else F.col("ts").desc()).write.parquet(f"{root}/in")
    served = ServingTable(spark, f"{root}/table", ["user_id"], "replace", ["ts", "event_id"])
    served.publish(served.write(events.filter("false"), "full"))
    stream = incremental.change_stream(spark, f"{root}/in", events.schema, files_per_batch=1)
    incremental.run_to_end(incremental.upsert_stream(stream, served, f"{root}/progress"))
    wanted = events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("m")).select("user_id", "m.event_id")
    assert rows(served.read().select("user_id", "event_id")) == rows(wanted)
    served.compact()
    assert rows(served.read().select("user_id", "event_id")) == rows(wanted)


def test_stream_continues_after_a_stop(spark, sf_dir, root):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    served = ServingTable(spark, f"{root}/table", ["user_id"], "replace", ["ts", "event_id"])
    served.publish(served.write(events.filter("false"), "full"))
    for part in (0, 1):
        events.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{root}/in")
        stream = incremental.change_stream(spark, f"{root}/in", events.schema)
        incremental.run_to_end(incremental.upsert_stream(stream, served, f"{root}/progress"))
    wanted = events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("m")).select("user_id", "m.event_id")
    assert rows(served.read().select("user_id", "event_id")) == rows(wanted)


def test_upsert_stream_needs_an_order(spark, root):
    with pytest.raises(ValueError):
        incremental.upsert_stream(spark.range(1), ServingTable(spark, root, ["id"]), root)


def test_late_rows_beyond_the_delay_are_dropped(spark, root):
    """Copies within the delay fall to the state, rows beyond it to the watermark."""
    schema = "id int, at timestamp"
    minute = lambda m: f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
    batches = [[(1, 0), (1, 0), (2, 30)], [(2, 30), (3, 300)], [(4, 305)], [(5, 10), (1, 0), (6, 299)]]
    for batch in batches:
        rows_ = spark.createDataFrame([(i, minute(m)) for i, m in batch], "id int, at string")
        rows_.withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = incremental.with_late_policy(incremental.change_stream(spark, f"{root}/in", spark.createDataFrame([], schema).schema, 1), "at", "60 minutes", ["id"])
    running = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start()
    incremental.run_to_end(running)
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2, 3, 4, 6]


def test_late_rows_stand_beside_those_on_time(spark, root):
    """No row is lost, a batch that runs again replaces itself, rows without a time are on time."""
    schema = "id int, at timestamp"
    minute = lambda m: None if m is None else f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
    batches = [[(1, 0), (2, 30)], [(3, 300)], [(4, 305), (5, 239), (6, 240)], [(7, 10), (8, None), (9, 299)]]
    for batch in batches:
        rows_ = spark.createDataFrame([(i, minute(m)) for i, m in batch], "id int, at string")
        rows_.withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{root}/in")
    read = lambda: incremental.change_stream(spark, f"{root}/in", spark.createDataFrame([], schema).schema, 1)
    incremental.run_to_end(incremental.split_late_stream(read(), "at", 3600, f"{root}/out", f"{root}/progress"))
    first = sorted((r["id"], r["late"], r["batch"]) for r in incremental.read_split(spark, f"{root}/out").collect())
    assert [(i, late) for i, late, _ in first] == [(i, i in (5, 7)) for i in range(1, 10)]
    # another run from the start writes the same batches again
    incremental.run_to_end(incremental.split_late_stream(read(), "at", 3600, f"{root}/out", f"{root}/again"))
    assert sorted((r["id"], r["late"], r["batch"]) for r in incremental.read_split(spark, f"{root}/out").collect()) == first
