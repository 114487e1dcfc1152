"""Scalar helpers on hand-made rows, with nulls and broken values."""

from __future__ import annotations

import hashlib

import pytest
from support import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.functions import hashing, nested, numbers, text, vectors


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def values(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_split_pipe_and_badges(spark):
    df = column(spark, ["a|b", "a", "", None, "|"])
    assert values(df, text.split_pipe("x")) == [["a", "b"], ["a"], None, None, ["", ""]]
    assert values(df, text.split_badges("x")) == [["a", "b"], ["a"], [], [], ["", ""]]


def test_badge_modes(spark):
    df = column(spark, ["cat|dog", "category", "", None])
    assert values(df, text.has_badge("x", "cat")) == [1, 0, 0, 0]
    assert values(df, text.has_badge("x", "cat", "substring")) == [1, 1, 0, 0]
    with pytest.raises(ValueError):
        text.has_badge("x", "cat", "regex")


def test_text_length_of_null_is_zero(spark):
    assert values(column(spark, ["abc", "", None, "日本"]), text.text_length("x")) == [3, 0, 0, 2]


def test_condense_and_tokens(spark):
    df = column(spark, [" a\tb \n c", None])
    assert values(df, text.condense("x")) == ["abc", None]
    assert values(df, text.tokens("x")) == [["a", "b", "c"], None]


def test_custom_tokenizer(spark):
    df = text.with_tokens(column(spark, ["a-b"]), ["x"], lambda c: F.split(c, "-"))
    assert df.columns == ["x", "x_token"] and df.first()["x_token"] == ["a", "b"]


def runs(bits):
    found, start = [], None
    for i, b in enumerate(bits + "0"):
        if b == "1" and start is None:
            start = i
        if b != "1" and start is not None:
            found.append(f"{start // 2:02d}:{start % 2 * 30:02d}-{i // 2:02d}:{i % 2 * 30:02d}")
            start = None
    return found


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("01", max_size=48), min_size=1, max_size=20))
def test_bit_ranges(spark, samples):
    assert values(column(spark, samples), text.bit_ranges("x", 30)) == [runs(b) for b in samples]


def test_bit_ranges_of_null(spark):
    assert values(column(spark, [None, "", "111"]), text.bit_ranges("x")) == [None, [], ["00:00-03:00"]]


def test_json_parsing(spark):
    df = column(spark, ['{"a": 1}', "{oops", None, "7"])
    assert [r and r["a"] for r in values(df, nested.parse_json("x", "a int"))] == [1, None, None, None]
    assert values(df, nested.looks_like_json_object("x")) == [True, False, None, False]
    arrays = column(spark, [['{"a": 1}', "bad"], [], None], "array<string>")
    got = values(arrays, nested.parse_json_array("x", "struct<a: int>"))
    assert [g and [i["a"] for i in g] for g in got] == [[1, None], [], None]


def test_json_or_raw_keeps_the_text(spark):
    got = nested.json_or_raw(column(spark, ['{"a": [1, 2]}', "plain", None]), "x")
    read = got.select("x", F.to_json("x_json"))
    assert [tuple(r) for r in read.collect()] == [('{"a": [1, 2]}', '{"a":[1,2]}'), ("plain", None), (None, None)]


def test_to_json_nulls(spark):
    df = spark.sql("select named_struct('a', 1, 'b', cast(null as int)) as x")
    assert values(df, nested.to_json_text("x")) == ['{"a":1}']
    assert values(df, nested.to_json_text("x", keep_nulls=True)) == ['{"a":1,"b":null}']


def test_merges_drop_their_sources(spark):
    df = spark.createDataFrame([(1, "a", None)], "id int, p string, q string")
    array = nested.merge_to_array(df, {"pq": ["p", "q"]})
    assert array.columns == ["id", "pq"] and array.first()["pq"] == ["a", None]
    struct = nested.merge_to_struct(df, {"p": ["p", "q"]})
    assert struct.columns == ["id", "p"] and struct.first()["p"].asDict() == {"p": "a", "q": None}


def test_numbers_under_ansi(spark):
    df = column(spark, ["3.5", "x", "", None])
    assert values(df, numbers.to_number("x")) == [3.5, None, None, None]
    nan = column(spark, [1.0, float("nan"), None], "double")
    assert values(nan, numbers.null_normalize("x")) == [1.0, None, None]
    assert values(nan, numbers.ratio(F.lit(1), F.lit(0))) == [None] * 3


@pytest.mark.parametrize(("p", "r", "wanted"), [(0.5, 0.5, 0.5), (1.0, 0.5, 2 / 3), (0.0, 0.5, None), (None, 0.5, None)])
def test_f1(spark, p, r, wanted):
    df = spark.createDataFrame([(p, r)], "p double, r double")
    got = df.select(numbers.f1(F.col("p"), F.col("r"))).first()[0]
    assert got == (wanted if wanted is None else pytest.approx(wanted))


def test_grid_point(spark):
    got = spark.range(100).select(numbers.grid_point(F.lit(2.0), F.lit(5.0), F.col("id"))).collect()
    assert got[0][0] == 2.0 and got[99][0] == 5.0 and got[5][0] == pytest.approx(2 + 3 * 5 / 99)


def test_earliest_skips_nulls(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None), (None, None)], "a int, b int")
    assert values(df, numbers.earliest("a", "b")) == [1, 2, 1, None]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0]), ([1.0, 2.0], None)], "x array<float>, y array<float>")
    assert values(df, vectors.pair_mean("x", "y")) == [[2.0, 3.0], [1.0, 2.0]]
    assert values(df, vectors.dot("x", "y")) == [11.0, None]


def test_key_hash_is_md5_of_seed_and_key(spark):
    wanted = int(hashlib.md5(b"42:7|a").hexdigest()[:15], 16)
    df = spark.createDataFrame([(7, "a", None)], "k int, s string, n string")
    assert values(df, hashing.key_hash("k", "s")) == [wanted]
    assert values(df, hashing.key_bucket("k", "s", buckets=10)) == [wanted % 10]
    assert values(df, hashing.key_hash("n")) == [int(hashlib.md5(b"42:").hexdigest()[:15], 16)]


def test_helpers_need_no_python_worker(spark):
    df = column(spark, ["a|b"]).select(text.split_badges("x"), text.bit_ranges("x"), text.condense("x"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(df)
