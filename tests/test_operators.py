"""Filters, joins, aggregates, ranking, sampling, merges."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from support import rows
from pyspark.sql import functions as F

from catalog import table
from larder.operators import aggregates, filters, joins, merge, ranking, sampling


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# --- filters --------------------------------------------------------------


def test_half_open_bounds_are_pushed(spark, sf_dir):
    df = filters.between_half_open(table(spark, sf_dir, "events"), "ts", datetime(2024, 1, 2), datetime(2024, 1, 3))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    edge = frame(spark, "t int", (1,), (2,), (3,))
    assert rows(filters.between_half_open(edge, "t", 1, 3)) == [(1,), (2,)]


def test_null_guard(spark):
    df = frame(spark, "a double, b string, c int", (1.0, "x", 1), (float("nan"), None, 2), (None, "y", 3))
    assert rows(filters.null_counts(df, ["a", "b", "c"])) == [("a", 2), ("b", 1), ("c", 0)]
    with pytest.raises(ValueError, match="a, b"):
        filters.assert_no_nulls(df, ["a", "b", "c"])
    filters.assert_no_nulls(df, ["c"])


def test_lengths(spark):
    df = frame(spark, "s string", ("a b c",), ("abc",), ("",), (None,), ("abcd",))
    assert rows(filters.with_exact_length(df, "s", 3)) == [("a b c",), ("abc",)]
    assert rows(filters.with_positive_length(df, "s").select("text_length")) == [(3,), (4,), (5,)]


# --- joins ----------------------------------------------------------------


def test_hot_key_join_equals_plain_join(spark):
    rng = random.Random(5)
    data = [(i, 0 if rng.random() < 0.4 else rng.randrange(1, 300) if rng.random() < 0.9 else None) for i in range(6000)]
    df = frame(spark, "id int, k int", *data)
    unique = frame(spark, "k int, v string", *[(k, f"v{k}") for k in range(0, 300, 2)])
    got = joins.join_salting_hot_keys(df, unique, ["k"], ["id"], parts=16)
    assert rows(got.select("id", "k", "v")) == rows(joins.attach(df, unique, "k").select("id", "k", "v"))


def test_hot_keys_are_few_and_split_by_share(spark):
    df = frame(spark, "k int", *[(0,)] * 500, *[(i,) for i in range(1, 501)])
    assert rows(joins.hot_keys(df, ["k"], 16)) == [(0, 8)]


def test_hot_key_pieces_land_in_several_groups(spark):
    df = frame(spark, "id int, k int", *[(i, 0) for i in range(1000)])
    unique = frame(spark, "k int, v int", (0, 1))
    plan = joins.join_salting_hot_keys(df, unique, ["k"], ["id"], parts=8)
    assert plan.count() == 1000 and "__salt" in plan._jdf.queryExecution().optimizedPlan().toString()


def test_null_keys(spark):
    left, right = frame(spark, "k string, a int", ("x", 1), (None, 2)), frame(spark, "k string, b int", ("x", 3), (None, 4))
    assert rows(joins.full_outer_unique(left, right, ["k"])) == [("x", 1, 3), (None, 2, None), (None, None, 4)]
    assert rows(joins.full_outer_unique(left, right, ["k"], null_safe=True)) == [("x", 1, 3), (None, 2, 4)]


def test_left_joins_keep_the_row_count(spark):
    df = frame(spark, "u int, i int", (1, 1), (1, 1), (1, 2), (2, 1))
    general = df.withColumn("f", F.col("u") * 10)
    assert rows(joins.attach_general(df, general, ["u", "i"], ["f"])) == [(1, 1, 10), (1, 1, 10), (1, 2, 10), (2, 1, 20)]


def test_fills(spark):
    df, feature = frame(spark, "k int", (1,), (2,), (3,)), frame(spark, "k int, f double", (1, 0.2), (2, 0.6))
    assert rows(joins.fill_with_mean(df, feature, "k", "f")) == [(1, 0.2), (2, 0.6), (3, pytest.approx(0.4))]
    assert rows(joins.fill_with_mean(df, feature, "k", "f", mean=0.1)) == [(1, 0.2), (2, 0.6), (3, 0.1)]
    assert rows(joins.fill_with_zero(df, feature, "k", ["f"])) == [(1, 0.2), (2, 0.6), (3, 0.0)]


def test_merge_documents(spark):
    ids = {"u": frame(spark, "u int", (1,), (2,), (None,))}
    a, b = frame(spark, "u int, a int", (1, 10), (9, 90)), frame(spark, "u int, b int", (2, 20))
    assert rows(joins.merge_documents(ids, [a, b])) == [(1, 10, None), (2, None, 20)]
    assert rows(joins.merge_documents(ids, [a.filter("false"), b])) == [(1, None, None), (2, None, 20)]
    assert rows(joins.merge_documents(ids, [])) == [(1,), (2,)]


def test_merge_documents_with_two_id_sets(spark):
    ids = {"u": frame(spark, "u int", (1,), (2,)), "i": frame(spark, "i int", (7,), (8,))}
    a, b = frame(spark, "u int, i int, a int", (1, 7, 5), (3, 7, 6)), frame(spark, "u int, i int, b int", (1, 7, 4))
    assert rows(joins.merge_documents(ids, [a, b]).select("u", "i", "a", "b")) == [(1, 7, 5, 4)]


def test_id_sets_restrict(spark):
    docs = frame(spark, "u int, v int", (1, 1), (2, 2), (3, 3))
    bare = frame(spark, "u int", (1,), (1,), (2,))
    assert rows(joins.restrict_to_id_sets(docs, {"u": bare})) == [(1, 1), (2, 2)]


def test_lookup_keeps_every_row(spark):
    df = frame(spark, "a int, b int", *[(i % 5, i) for i in range(101)])
    store = frame(spark, "k int, v string", (0, "x"), (0, "y"), (1, "z"))
    got = joins.lookup(df, store, {"a": "k"}, {"v": "found"})
    assert got.count() == 101 and rows(got.select("a", "found").distinct()) == [(0, "y"), (1, "z"), (2, None), (3, None), (4, None)]


# --- aggregates and ranking -----------------------------------------------


def test_latest_per_key_ignores_input_order(spark):
    data = [(k, t, f"{k}{t}") for k in range(5) for t in range(20)]
    wanted = [(k, f"{k}19") for k in range(5)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = frame(spark, "k int, t int, v string", *data).repartition(7)
        assert rows(aggregates.latest_per_key(df, ["k"], ["t"], ["v"])) == wanted


def test_positive_ratio_skips_text(spark):
    df = frame(spark, "i int, s string", (1, "3"), (1, "2.9"), (1, "n/a"), (2, "x"), (2, None))
    assert rows(aggregates.positive_ratio(df, "i", "s")) == [(1, 1, 1, 0.5), (2, 0, 0, None)]


def test_sorted_tags_repeat(spark):
    df = frame(spark, "i int, t string", (1, "b"), (1, "a"), (1, "b"), (2, None))
    assert rows(aggregates.sorted_tag_text(df, "i", "t")) == [(1, "a b b"), (2, "")]


def test_distinct_categories_drop_empty(spark):
    df = frame(spark, "b string", ("x|y",), ("y||z",), ("",), (None,))
    assert rows(aggregates.distinct_categories(df, "b")) == [("x",), ("y",), ("z",)]


def test_metrics_without_predictions(spark):
    df = frame(spark, "l int, p int", (1, 0), (0, 0))
    got = aggregates.classification_metrics(df, "l", "p").first()
    assert (got["precision"], got["recall"], got["f1"], got["n"]) == (None, 0.0, None, 2)


def test_vector_mean_skips_null(spark):
    df = frame(spark, "k int, v array<float>", (1, [1.0, 3.0]), (1, [3.0, 5.0]), (1, None), (2, [0.0, 1.0]))
    assert rows(aggregates.vector_mean(df, ["k"], "v")) == [(1, [2.0, 4.0]), (2, [0.0, 1.0])]


@pytest.mark.parametrize("rows_per_group", [1, 7, 500])
def test_dense_ids(spark, rows_per_group):
    df = frame(spark, "c string, k int", *[("a", i) for i in range(50)], *[("b", i) for i in range(3)])
    got = ranking.dense_ids(df, "k", ["c"], rows_per_group=rows_per_group)
    per = {c: sorted(r["vid"] for r in got.filter(F.col("c") == c).collect()) for c in "ab"}
    assert per == {"a": list(range(50)), "b": [0, 1, 2]}
    assert rows(got) == rows(ranking.dense_ids(df.repartition(5), "k", ["c"], rows_per_group=rows_per_group))


def test_dense_ids_keep_a_null_category(spark):
    df = frame(spark, "c string, k int", ("a", 1), (None, 2), (None, 3))
    got = ranking.dense_ids(df, "k", ["c"])
    assert got.columns == ["c", "k", "vid"] and sorted((r["c"] or "", r["vid"]) for r in got.collect()) == [("", 0), ("", 1), ("a", 0)]


def test_next_id(spark):
    df = frame(spark, "i int", (4,), (2,))
    assert ranking.next_id(df, "i").first()[0] == 5 and ranking.next_id(df.filter("false"), "i").first()[0] == 1


# --- sampling -------------------------------------------------------------


def test_sample_is_stable_under_repartition(spark):
    df = spark.range(5000)
    one = rows(sampling.sample_by_key(df, ["id"], 0.1))
    assert one == rows(sampling.sample_by_key(df.repartition(13), ["id"], 0.1)) and 400 < len(one) < 600


@pytest.mark.parametrize("factor", [0.0, 0.001, 0.37, 0.5, 0.999, 1.0])
def test_exact_sample_size(spark, factor):
    df = spark.range(3001)
    got = rows(sampling.sample_exact(df, ["id"], factor))
    assert len(got) == int(factor * 3001) == len(set(got))
    assert got == rows(sampling.sample_exact(df.repartition(3), ["id"], factor))


def test_small_fractions_are_not_rounded(spark):
    df = spark.range(1_000_000)
    for fraction, want in ((0.0004, 400), (0.0005, 500), (0.0016, 1600)):
        assert abs(sampling.sample_by_key(df, ["id"], fraction).count() - want) < 5 * want**0.5


@pytest.mark.parametrize("edge_rows", [1, 50])
def test_exact_sample_by_levels(spark, edge_rows):
    """Several levels of histograms, equal hashes included, end at the same rows."""
    df = spark.range(5000)
    want = rows(sampling.sample_exact(df, ["id"], 0.37))
    assert rows(sampling.sample_exact(df, ["id"], 0.37, edge_rows=edge_rows)) == want


def test_exact_sample_writes_few_keys(spark, monkeypatch):
    """The quota ends inside the sketched bracket, which is small; a sketch that misses changes no row."""
    df, seen = spark.range(200_000), []
    original = sampling.session.materialise
    monkeypatch.setattr(sampling.session, "materialise", lambda d, name: seen.append(original(d, name)) or seen[-1])
    got = sampling.sample_exact(df, ["id"], 0.37)
    assert got.count() == 74_000 and len(seen) == 1 and seen[0].count() < 0.01 * 200_000
    want = rows(got)
    monkeypatch.setattr(sampling, "BRACKET", -0.2)  # an empty bracket: the whole table is ranked
    assert rows(sampling.sample_exact(df, ["id"], 0.37)) == want


def test_dense_ids_do_not_depend_on_groups(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    want = rows(ranking.dense_ids(df, "k"))
    assert sorted(r[1] for r in want) == list(range(3000))
    cut = ranking.dense_ids(df, "k", rows_per_group=100)
    assert rows(cut) == want
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "__bucket" in plan


def test_exact_sample_of_nothing(spark):
    assert sampling.sample_exact(spark.range(0), ["id"], 0.5).count() == 0


def test_phases_are_disjoint_and_complete(spark):
    df = spark.range(4000)
    phased = sampling.split_phases(df.unionAll(df), ["id"])
    sizes = {r["phase"]: r["n"] for r in sampling.phase_counts(phased).collect()}
    assert sum(sizes.values()) == 8000 and 600 < sizes["test"] < 1000 and 500 < sizes["validation"] < 850
    assert phased.groupBy("id").agg(F.count_distinct("phase").alias("n")).filter("n > 1").count() == 0


def test_inflation(spark):
    df = frame(spark, "c string, i int", *[("big", i) for i in range(90)], *[("small", i) for i in range(10)], ("other", 1))
    got = sampling.inflate_classes(df, "c", ["big", "small"])
    counts = {r["c"]: r["n"] for r in got.groupBy("c").agg(F.count("*").alias("n")).collect()}
    assert counts == {"big": 90, "small": 10 * (int(0.5 * (101 / 2) / 10) + 1)}


def test_subtract_and_duplicates(spark):
    a, b = frame(spark, "x int, y int", (1, 1), (1, 1), (2, 2)), frame(spark, "y int, x int", (1, 1))
    assert rows(sampling.subtract(a, b)) == [(2, 2)]
    assert rows(sampling.subtract(a, b, keep_duplicates=True)) == [(1, 1), (2, 2)]


def test_union_goes_by_name(spark):
    a, b = frame(spark, "x int, y int", (1, 2)), frame(spark, "y int, x int", (2, 1))
    assert rows(sampling.union_all(a, b)) == [(1, 2), (1, 2)]


# --- merges ---------------------------------------------------------------


def test_partial_upsert(spark):
    base = frame(spark, "id int, a string, b string", (1, "a", "b"), (2, "a", "b"), (None, "n", "n"))
    delta = frame(spark, "id int, a string, c int", (2, None, 7), (3, "z", 8))
    wanted = [(1, "a", "b", None), (2, None, "b", 7), (3, "z", None, 8), (None, "n", "n", None)]
    once = merge.upsert_partial(base, delta, ["id"])
    assert rows(once) == wanted and rows(merge.upsert_partial(once, delta, ["id"])) == wanted


def test_replacing_upsert(spark):
    base = frame(spark, "id int, a string, b string", (1, "a", "b"), (2, "a", "b"))
    delta = frame(spark, "id int, a string", (2, "z"), (3, "y"))
    assert rows(merge.upsert_replace(base, delta, ["id"])) == [(1, "a", "b"), (2, "z", None), (3, "y", None)]


def test_merge_rules(spark):
    schema = "id int, s int, lo int, hi int, l string, o string, t array<string>, keep int"
    base = frame(spark, schema, (1, 5, 5, 5, "old", "old", ["a"], 1), (2, 1, 1, 1, "x", "x", None, 2))
    delta = frame(spark, schema, (1, 2, 2, 9, None, None, ["b"], 9), (3, 7, 7, 7, "n", "n", ["c"], 3))
    rules = {"s": "sum", "lo": "min", "hi": "max", "l": "last", "o": "overwrite", "t": "append"}
    assert rows(merge.merge_aggregate(base, delta, ["id"], rules)) == [
        (1, 7, 2, 9, "old", None, ["a", "b"], 1),
        (2, 1, 1, 1, "x", "x", None, 2),
        (3, 7, 7, 7, "n", "n", ["c"], 3),
    ]


def test_pre_aggregation(spark):
    delta = frame(spark, "id int, n int, l string, o string, at int", (1, 1, "a", "a", 1), (1, 2, None, None, 2))
    rules = {"n": "sum", "l": "last", "o": "overwrite"}
    assert rows(merge.pre_aggregate(delta, ["id"], rules, ["at"])) == [(1, 3, "a", None)]
    with pytest.raises(ValueError):
        merge.pre_aggregate(delta, ["id"], {"l": "append"}, ["at"])


def test_merging_parts_equals_merging_the_whole(spark):
    data = frame(spark, "id int, n int, best int", *[(i % 7, i, i * 31 % 17) for i in range(200)]).withColumn("at", F.col("n"))
    rules = {"n": "sum", "best": "max"}

    def folded(df):
        return merge.pre_aggregate(df, ["id"], rules, ["at"])

    parts = folded(data.filter("at < 60"))
    for low, high in ((60, 130), (130, 200)):
        parts = merge.merge_aggregate(parts, folded(data.filter(f"at >= {low} and at < {high}")), ["id"], rules)
    assert rows(parts.select("id", "n", "best")) == rows(folded(data))


@pytest.mark.parametrize(("data", "wanted"), [([(3,)], True), ([(0,)], False), ([(None,)], False), ([], False), ([(1,), (2,)], False)])
def test_trigger(spark, data, wanted):
    assert merge.change_trigger(spark.createDataFrame(data, "n int"), "n").first()[0] is wanted


def test_window_bounds(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as t, id from range(100)")
    end = F.lit("2024-01-01 00:01:00").cast("timestamp_ntz")
    assert [r["id"] for r in df.filter(merge.in_window("t", end, 5)).orderBy("id").collect()] == [55, 56, 57, 58, 59]


def test_lists_are_appended_by_rows(spark):
    """A hot id of half of all rows, cut into slices and chunks; a second part comes after the first."""
    made = [(0 if i % 2 else i % 7, i * 37 % 1000, f"v{i}") for i in range(1000)]
    frame = lambda r: spark.createDataFrame(r, "id int, at int, v string").repartition(4)
    parts = [made[:700], made[700:]]
    chunks = [merge.list_chunks(frame(p), ["id"], "v", ["at"], n, per_chunk=2) for n, p in enumerate(parts)]
    both = chunks[0].unionByName(chunks[1])
    assert both.agg(F.max(F.size("values"))).first()[0] == 2 and both.agg(F.max("slice")).first()[0] > 1
    got: dict[int, list] = {}
    for r in sorted(merge.list_values(both, ["id"]).collect(), key=lambda r: (r.part, r.slice, r.chunk, r.place)):
        got.setdefault(r.id, []).append(r.value)
    want: dict[int, list] = {}
    for p in parts:
        for i, _, v in sorted(p, key=lambda r: r[1]):
            want.setdefault(i, []).append(v)
    assert got == want
    assert merge.list_chunks(frame(made).limit(0), ["id"], "v", ["at"], 0).count() == 0


def test_slices_follow_the_longest_list(spark):
    """Many short lists are one slice, however many rows there are; equal and null order values have one place."""
    short = spark.range(5000).selectExpr("id div 10 as id", "id * 37 % 1000 as at", "id as v")
    assert merge.list_chunks(short, ["id"], "v", ["at", "v"], 0, per_chunk=2).agg(F.max("slice")).first()[0] == 0
    bounds, values = [3, 3, 3, 7, 20, 20], [None, -1, 2, 3, 4, 7, 8, 19, 20, 99]
    got = spark.createDataFrame([(v,) for v in values], "v int").select("v", merge._bounds_upto(bounds, F.col("v")).alias("n")).collect()
    assert {r.v: r.n for r in got} == {v: sum(v is not None and b <= v for b in bounds) for v in values}
