"""Schema inference, registration, projections."""

from __future__ import annotations

import math
from datetime import date, datetime, time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources import schemas

TAGS = {"play": 3, "read": 2, "sing": 1}


@pytest.mark.parametrize(
    ("value", "wanted"),
    [
        ("13000", "string"),
        (296.0, "double"),
        (TAGS, "struct<play:bigint,read:bigint,sing:bigint>"),
        ('{"play": 3, "read": 2, "sing": 1}', "struct<play:bigint,read:bigint,sing:bigint>"),
        (["play", "read"], "array<string>"),
        ([0.5, 0.1], "array<double>"),
        ([], "array<string>"),
        (float("nan"), "double"),
        (True, "boolean"),
        (2**40, "bigint"),
        (datetime(2024, 1, 1, 5), "timestamp"),
        (date(2024, 1, 1), "date"),
        (time(5, 30), "string"),
        ("{not json", "string"),
        ({"a": {"b": [1]}}, "struct<a:struct<b:array<bigint>>>"),
    ],
)
def test_value_type(value, wanted):
    assert schemas.value_type(value).simpleString() == wanted


def test_batch_takes_first_non_null_and_keeps_order():
    batch = [{"b": None, "a": 1}, {"b": 2.5, "a": "x", "c": None}]
    assert schemas.infer_batch(batch).simpleString() == "struct<b:double,a:bigint,c:string>"


def test_batch_predefined_wins_only_for_known_fields():
    inferred = schemas.infer_batch([{"a": 1, "b": 2}], {"b": 0.5, "z": 1})
    assert inferred.simpleString() == "struct<a:bigint,b:double>"


def test_json_schema_over_all_rows(spark):
    texts = ['{"a": 1, "t": {"x": "y"}}', '{"a": 2.5, "l": [1]}', "plain", None, '{"n": null}']
    df = spark.createDataFrame([(t,) for t in texts], "doc string")
    inferred = {f.name: f.dataType.simpleString() for f in schemas.infer_json_schema(df, "doc").fields}
    assert inferred == {"a": "double", "t": "struct<x:string>", "l": "array<bigint>", "n": "string"}


def test_json_schema_of_plain_text(spark):
    df = spark.createDataFrame([("plain",)], "doc string")
    assert schemas.infer_json_schema(df, "doc").fields == []


def test_merge_keeps_first_place_and_last_type():
    a, b = T.StructType.fromDDL("x int, y string"), T.StructType.fromDDL("z date, x bigint")
    assert schemas.merge_schemas(a, b).simpleString() == "struct<x:bigint,y:string,z:date>"


def test_register_actions(spark, root):
    one, two = T.StructType.fromDDL("a int"), T.StructType.fromDDL("b int")
    with pytest.raises(FileNotFoundError):
        schemas.register_schema(spark, root, "docs", one, "update")
    assert not schemas.register_schema(spark, root, "docs", one, "skip")
    assert schemas.register_schema(spark, root, "docs", one, "create", "20240101_000000_000000")
    assert not schemas.register_schema(spark, root, "docs", two, "create")
    assert schemas.registered_schema(spark, root, "docs") == one
    assert schemas.register_schema(spark, root, "docs", two, "update", "20240102_000000_000000")
    assert schemas.registered_schema(spark, root, "docs") == two
    assert schemas.registered_schema(spark, root, "docs", "20240101_000000_000000") == one
    with pytest.raises(ValueError):
        schemas.register_schema(spark, root, "docs", two, "both")


def test_conform_skips_missing_and_types_defaults(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    got = schemas.conform(df, ["b", "zz", "a"], {"n": 3, "r": 0.5, "s": "t"})
    assert got.schema.simpleString() == "struct<b:string,a:int,n:bigint,r:double,s:string>"
    assert tuple(got.first()) == ("x", 1, 3, 0.5, "t")


def test_decimals_become_doubles(spark):
    df = spark.sql("select cast(1.25 as decimal(10,2)) as d, 1 as i")
    assert schemas.decimals_to_double(df).schema.simpleString() == "struct<d:double,i:int>"
    assert math.isclose(schemas.decimals_to_double(df).first()["d"], 1.25)


def test_time_text(spark):
    row = spark.sql("select timestamp_ntz '2024-01-01 03:05:09' as t").select(
        schemas.time_text(F.col("t")).alias("short"), schemas.time_text(F.col("t"), "HH:mm:ss").alias("long")
    )
    assert tuple(row.first()) == ("3:5", "03:05:09")


def test_cast_to_declared_schema(spark):
    df = spark.createDataFrame([(1, "7")], "a int, b string")
    got = schemas.cast_to(df, T.StructType.fromDDL("b int, c double, a string"))
    assert tuple(got.first()) == (7, None, "1")


def test_feature_names_and_map():
    names = schemas.feature_names(["k", "x", "label", "e", "y"], ["k"], "label", ["e"])
    assert names == ["x", "y"] and schemas.feature_name_map(names) == {"x": "f0", "y": "f1"}
