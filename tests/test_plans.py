"""Labels, windows, marts, keyword thresholds, corpora."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from support import rows
from pyspark.sql import functions as F

from catalog import bindings, table
from larder.operators import joins, keywords
from larder.plans import corpus, features, labels, mart, terms
from larder.plans.windows import ORDINAL, PeriodWindows, PhaseWindows, pit_join

LOG = "recommendation_sid string, user_account_sid int, item_sid int, logged_at int, kind string, place string"


def log(spark, *data):
    return spark.createDataFrame(list(data), LOG)


def spec(**options):
    return labels.LabelSpec("kind = 'ask'", "kind = 'hit'", negative_fraction=1.0, **options)


def test_labels(spark):
    df = log(
        spark,
        ("r1", 1, 10, 5, "ask", "a"),
        ("r1", 1, 10, 3, "ask", "a"),
        ("r1", 1, 10, 9, "hit", "a"),
        ("r1", 1, 11, 6, "ask", "a"),
        ("r1", 1, 12, 7, "hit", "a"),
        ("r2", 2, 10, 8, "ask", "b"),
        ("r3", 3, 10, 8, "other", "b"),
    )
    got = labels.labeled_interactions(df, spec(user_attributes=["place"]))
    assert got.columns == ["user_account_sid", "recommendation_sid", "item_sid", "logged_at", "label", "place"]
    assert rows(got) == [(1, "r1", 10, 3, 1, "a"), (1, "r1", 11, 6, 0, "a"), (1, "r1", 12, 7, 1, "a")]


def test_null_extras_do_not_pair(spark):
    df = log(spark, ("r", 1, 10, 5, "ask", None), ("r", 1, 10, 9, "hit", None))
    apart = labels.labeled_interactions(df, spec(extras=["place"]))
    assert rows(apart.select("logged_at", "label")) == [(5, 0), (9, 1)]
    paired = labels.labeled_interactions(df, spec(extras=["place"], null_safe=True))
    assert rows(paired.select("logged_at", "label")) == [(5, 1)]


def test_positives_survive_sampling(spark, sf_dir):
    log_ = bindings.interaction_log(spark, sf_dir)
    every = labels.labeled_interactions(log_, bindings.label_spec(1.0))
    some = labels.labeled_interactions(log_.repartition(9), bindings.label_spec(0.1))
    assert rows(some.filter("label = 1")) == rows(every.filter("label = 1"))
    assert some.exceptAll(every).count() == 0


# --- windows --------------------------------------------------------------

START = datetime(2024, 1, 8)


def test_window_frame(spark):
    windows = PeriodWindows(START, START + timedelta(days=10), 4, gap_days=1)
    assert windows.count == 3
    got = windows.frame(spark).orderBy(ORDINAL).collect()
    for n, row in enumerate(got):
        assert row["start"] == START + timedelta(days=4 * n)
        assert row["prev_end"] == row["start"] - timedelta(days=1) and row["prev_start"] == row["prev_end"] - timedelta(days=4)
    assert got[-1]["end"] == START + timedelta(days=10)


@pytest.mark.parametrize("bad", [(START, START, 7, 0), (START, START + timedelta(days=1), 0, 0), (START, START + timedelta(days=1), 1, -1)])
def test_bad_windows(bad):
    with pytest.raises(ValueError):
        PeriodWindows(*bad)


@pytest.mark.parametrize(("period", "gap"), [(7, 0), (3, 2), (1, 0), (5, 1)])
def test_no_leakage_and_row_count(spark, sf_dir, period, gap):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    end = datetime(2024, 1, 31)
    windows = PeriodWindows(START, end, period, gap)
    seen = [F.max("ts").alias("last"), F.min("ts").alias("first"), F.count("*").alias("n")]
    got = pit_join(events, events, windows, ["user_id"], "ts", "ts", seen, ["event_id"])
    assert got.count() == events.filter(f"ts >= '{START}' and ts < '{end}'").count()
    bounds = got.join(windows.frame(spark), ORDINAL)
    assert bounds.filter("last >= prev_end or first < prev_start or ts < start or ts >= end").count() == 0
    assert bounds.filter("n is not null").count() > 0


def test_phases_may_overlap(spark):
    df = spark.createDataFrame([(1, START), (2, START + timedelta(days=3))], "id int, ts timestamp_ntz")
    both = PhaseWindows(
        {
            "a": PeriodWindows(START, START + timedelta(days=4), 2),
            "b": PeriodWindows(START + timedelta(days=3), START + timedelta(days=5), 2),
        }
    )
    got = both.targets(df, "ts").select("id", "phase", ORDINAL)
    assert rows(got) == [(1, "a", 0), (2, "a", 1), (2, "b", 0)]
    assert rows(both.sources(df, "ts").select("id", "phase", ORDINAL)) == [(1, "a", 1)]


# --- features and mart ----------------------------------------------------


def test_unknown_feature():
    registry = features.FeatureRegistry().register(features.GeneralFeature("x", ["x"], lambda df: df))
    assert registry.general("x").fields == ["x"]
    with pytest.raises(features.FeatureNotFound):
        registry.periodic("x")
    with pytest.raises(features.FeatureNotFound):
        registry.general("y")


def test_too_many_badges_is_an_error(spark):
    df = spark.createDataFrame([("a|b|c",)], "b string")
    assert features.badge_names(df, "b") == ["a", "b", "c"]
    with pytest.raises(ValueError):
        features.badge_names(df, "b", at_most=2)


def test_mart_without_periodic_features(spark):
    df = spark.createDataFrame([(1, START, 0, "x"), (2, START + timedelta(days=9), 1, "y")], "u int, logged_at timestamp_ntz, label int, e string")
    made = features.GeneralFeature("f", ["f"], lambda d: d.withColumn("f", F.col("u") * 2))
    plan = mart.MartSpec(keys=["u"], sample_keys=["u"], extras=["e"], general=["f"])
    phases = [mart.Phase("training", START, START + timedelta(days=7)), mart.Phase("test", START + timedelta(days=7), START + timedelta(days=14))]
    got = mart.mart_dataset(df, features.FeatureRegistry().register(made), plan, phases)
    assert rows(got.select("u", "label", "phase", "f")) == [(1, 0, "training", 2), (2, 1, "test", 4)]
    assert mart.mart_features(got, plan) == ["f"] and "e" not in got.columns


def test_mart_keeps_the_rows_of_its_phases(spark, sf_dir):
    from catalog import job_queries

    labeled = labels.labeled_interactions(bindings.interaction_log(spark, sf_dir), bindings.label_spec(0.5))
    whole = [mart.Phase(p.name, p.start, p.end) for p in job_queries.PHASES]
    got = mart.mart_dataset(labeled, job_queries.mart_registry(spark, sf_dir), job_queries.MART_SPEC, whole)
    inside = labeled.filter(f"logged_at >= '{job_queries.START}' and logged_at < '{job_queries.END}'")
    assert got.count() == inside.count()
    sampled = mart.mart_dataset(labeled, job_queries.mart_registry(spark, sf_dir), job_queries.MART_SPEC, job_queries.PHASES)
    assert sampled.exceptAll(got).count() == 0 and 0 < sampled.filter("phase = 'test'").count() < got.filter("phase = 'test'").count()


# --- keywords -------------------------------------------------------------

WORDS = ["red ring", "red rod", "red rod", "tin ring", "tin", "a", "golden goose", "old tin rod"]


def by_hand(words):
    condensed = ["".join(w.split()) for w in words]
    ones = Counter(c for w in condensed for c in w)
    twos = Counter(w[i : i + 2] for w in condensed for i in range(len(w) - 1))
    n = sum(ones.values())
    return {p: c / n * math.log2(c / ones[p[0]]) for p, c in twos.items()}


def test_terms_and_thresholds(spark):
    df = spark.createDataFrame([(w,) for w in [*WORDS, None]], "k string")
    made = keywords.pair_terms(keywords.frequency_tables(df, "k"))
    want = by_hand(WORDS)
    assert {r["cooccur"]: pytest.approx(r["term"]) for r in made.collect()} == want
    per_word = {r["keyword"]: r for r in keywords.keyword_terms(df, "k", made).collect()}
    assert per_word["red rod"]["terms"] == pytest.approx([want[p] for p in ("re", "ed", "dr", "ro", "od")])
    assert per_word["red rod"]["entropy"] == pytest.approx(-sum(per_word["red rod"]["terms"]))
    limits = {r["length"]: r for r in terms.term_thresholds(df, "k").collect()}
    for length, row in limits.items():
        for side, pair in (("first_threshold", slice(0, 2)), ("last_threshold", slice(-2, None))):
            condensed = {"".join(w.split()) for w in set(WORDS)}
            ends = [want[c[pair]] for w in set(WORDS) if len(c := "".join(w.split())) == length and want[c[pair]] < 0]
            wanted = np.linspace(-max(ends), -min(ends), 100)[1 if length > 5 else 5] if ends else None
            assert row[side] == (wanted if wanted is None else pytest.approx(wanted)), (condensed, length, side)


def test_refinement_cuts_below_the_threshold(spark):
    bounds = spark.createDataFrame(
        [("ab cd", "abcd", 4, -0.1, -0.9), ("xyz", "xyz", 3, -0.9, -0.9)],
        "keyword string, condensed string, length int, first_term double, last_term double",
    )
    limits = spark.createDataFrame([(4, 0.5, 0.5)], "length int, first_threshold double, last_threshold double")
    assert rows(terms.apply_thresholds(bounds, limits)) == [("ab cd", True, False, "bcd"), ("xyz", False, False, "xyz")]


# --- corpus ---------------------------------------------------------------


@pytest.mark.parametrize("inflate_first", [False, True])
def test_no_copy_crosses_a_phase(spark, inflate_first):
    df = spark.createDataFrame([(i, "a" if i % 20 else "b", i % 3) for i in range(400)], "id int, c string, r int")
    adhoc = df.select("id", F.array(F.col("id").cast("float")).alias("embedding"))
    static = df.select("r", "c").distinct().withColumn("vector", F.array(F.col("r").cast("float")))
    got = corpus.vector_corpus(df, "c", ["a", "b"], "id", adhoc, static, ["r", "c"], inflate_first=inflate_first)
    assert got.groupBy("id").agg(F.count_distinct("phase").alias("n")).filter("n > 1").count() == 0
    assert got.select("id").distinct().count() == 400
    assert got.filter("adhoc_vector[0] <> id or static_vector[0] <> r").count() == 0
    held_out = got.filter("phase <> 'train' and copy > 1").count()
    assert (held_out > 0) == inflate_first
    assert joins.default_parts(df) >= 8
