"""Schemas as data: infer, merge, register, conform."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime, time
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import nested
from larder.sources import files
from larder.sources import snapshots

_SCALARS: tuple[tuple[type, T.DataType], ...] = (
    (bool, T.BooleanType()),
    (int, T.LongType()),
    (float, T.DoubleType()),
    (Decimal, T.DoubleType()),
    (datetime, T.TimestampType()),
    (date, T.DateType()),
    (time, T.StringType()),
)


def _json_object(value: Any) -> dict | None:
    if not isinstance(value, str) or not value.strip().startswith("{"):
        return None
    try:
        parsed = json.loads(value)
    except ValueError:
        return None
    return parsed if isinstance(parsed, dict) and parsed else None


def value_type(value: Any) -> T.DataType:
    """Spark type of one sample value.

    A dict, or text that holds a JSON object, is a struct; a list takes the type
    of its first element, an empty list holds text.  Integers are 64 bit, floats
    double precision, a date with a time is a timestamp, anything unknown text.
    """
    fields = value if isinstance(value, dict) else _json_object(value)
    if fields is not None:
        return T.StructType([T.StructField(k, value_type(v)) for k, v in fields.items()])
    if isinstance(value, (list, tuple)):
        return T.ArrayType(value_type(value[0]) if value else T.StringType())
    return next((t for kind, t in _SCALARS if isinstance(value, kind)), T.StringType())


def infer_batch(rows: Iterable[Mapping[str, Any]], predefined: Mapping[str, Any] | None = None) -> T.StructType:
    """Schema of a small batch of records, for example a page of an API answer.

    Fields keep the order in which they are first seen; the first non-null value
    decides the type; a predefined sample value wins.  A field that is always
    null is text.
    """
    samples: dict[str, Any] = {}
    for row in rows:
        for name, value in row.items():
            if samples.get(name) is None:
                samples[name] = value
    samples |= {k: v for k, v in (predefined or {}).items() if k in samples}
    return T.StructType([T.StructField(k, value_type(v)) for k, v in samples.items()])


def _spark_type(variant_type: str) -> T.DataType:
    """Type text of a Variant aggregate to a Spark type: numbers with a fraction
    are doubles, always-null or conflicting values are text."""
    text = variant_type.replace("OBJECT<", "STRUCT<")
    text = re.sub(r"DECIMAL\(\d+, ?\d+\)", "DOUBLE", text)
    return T._parse_datatype_string(re.sub(r"\b(VOID|VARIANT)\b", "STRING", text))


def infer_json_schema(df: DataFrame, column: str, predefined: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """Schema of a column of JSON objects, merged over all rows by Spark.

    Only the merged schema comes back to the driver.  ``predefined`` replaces
    the type of the named top-level fields.
    """
    objects = F.when(nested.looks_like_json_object(column), F.try_parse_json(F.col(column)))
    inferred = _spark_type(df.agg(F.schema_of_variant_agg(objects).alias("schema")).first()["schema"])
    if not isinstance(inferred, T.StructType):
        return T.StructType()
    override = dict(predefined or {})
    return T.StructType([T.StructField(f.name, override.get(f.name, f.dataType)) for f in inferred.fields])


def schema_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A schema as (position, field, type) rows."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "position int, field string, type string")


def nest_json_columns(df: DataFrame, columns: Mapping[str, T.DataType | str]) -> DataFrame:
    """Replace JSON-object text columns by nested values of the given types."""
    return df.withColumns({c: nested.parse_json(c, t) for c, t in columns.items()})


def normalize_values(
    df: DataFrame, json_columns: Mapping[str, T.DataType | str] | None = None, time_format: str | None = None
) -> DataFrame:
    """Bring values into the form in which they are landed.

    Text holding JSON objects becomes nested, TIME columns become text.
    ``time_format`` is a pattern for times; the default writes hour:minute
    without leading zeros.
    """
    df = nest_json_columns(df, json_columns or {})
    times = [f.name for f in df.schema.fields if f.dataType.typeName().startswith("time(")]
    return df.withColumns({c: time_text(F.col(c), time_format) for c in times}) if times else df


def time_text(c, time_format: str | None = None):
    """A time or timestamp as text, ``H:m`` unless a pattern is given."""
    if time_format is not None:
        return F.date_format(c, time_format)
    return F.concat_ws(":", F.hour(c).cast("string"), F.minute(c).cast("string"))


def merge_schemas(*sources: T.StructType) -> T.StructType:
    """Merge by field name: the place of the first, the definition of the last."""
    return T.StructType(list({f.name: f for s in sources for f in s.fields}.values()))


def schema_root(root: str, schema_type: str) -> str:
    return f"{root}/{schema_type}.schema"


def register_schema(
    spark: SparkSession,
    root: str,
    schema_type: str,
    schema: T.StructType,
    action: str,
    snapshot: str | None = None,
    keep: int | None = None,
) -> bool:
    """Create or update a registered schema; returns whether it was written.

    ``create`` leaves an existing schema alone, ``update`` needs one, ``skip``
    does nothing.
    """
    if action not in ("create", "update", "skip"):
        raise ValueError(f"unknown action {action!r}")
    target = schema_root(root, schema_type)
    known = bool(snapshots.complete_snapshots(spark, target))
    if action == "update" and not known:
        raise FileNotFoundError(f"nothing to update at {target}")
    if action == "skip" or (action == "create" and known):
        return False
    name = snapshot or snapshots.snapshot_now()
    files.make_directory(spark, f"{target}/{name}")
    files.write_text(spark, f"{target}/{name}/data.json", schema.json())
    files.write_text(spark, f"{target}/{name}/_SUCCESS", "")
    snapshots.retain_snapshots(spark, target, keep)
    return True


def registered_schema(spark: SparkSession, root: str, schema_type: str, pinned: str | None = None) -> T.StructType:
    path = snapshots.resolve_snapshot(spark, schema_root(root, schema_type), pinned)
    return T.StructType.fromJson(json.loads(files.read_text(spark, f"{path}/data.json")))


def register_merged(
    spark: SparkSession, root: str, schema_type: str, sources: Sequence[str], action: str, **options: Any
) -> bool:
    """Register the merge of already registered schemas."""
    merged = merge_schemas(*[registered_schema(spark, root, s) for s in sources])
    return register_schema(spark, root, schema_type, merged, action, **options)


def conform(df: DataFrame, wanted: Sequence[str], defaults: Mapping[str, Any] | None = None) -> DataFrame:
    """Keep the wanted columns that exist, then add typed constants."""
    kept = df.select([c for c in wanted if c in df.columns])
    constants = {n: F.lit(v).cast(value_type(v)) for n, v in (defaults or {}).items()}
    return kept.withColumns(constants) if constants else kept


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a schema: cast what exists, null for what does not."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def decimals_to_double(df: DataFrame) -> DataFrame:
    found = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in found}) if found else df


def feature_names(
    columns: Sequence[str], keys: Sequence[str], label: str, extras: Sequence[str] = ()
) -> list[str]:
    """All columns that are neither key, label nor extra, in column order."""
    other = {*keys, label, *extras}
    return [c for c in columns if c not in other]


def feature_name_map(features: Sequence[str]) -> dict[str, str]:
    """Positional names ``f0``, ``f1``, … for features."""
    return {name: f"f{i}" for i, name in enumerate(features)}


def rename_features(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def save_feature_map(spark: SparkSession, root: str, snapshot: str, mapping: Mapping[str, str], schema: T.StructType) -> None:
    files.make_directory(spark, f"{root}/{snapshot}")
    files.write_text(spark, f"{root}/{snapshot}/feature_name_map.json", json.dumps(dict(mapping), ensure_ascii=False))
    files.write_text(spark, f"{root}/{snapshot}/schema.json", schema.json())
    files.write_text(spark, f"{root}/{snapshot}/_SUCCESS", "")


def load_feature_map(spark: SparkSession, root: str, pinned: str | None = None) -> dict[str, str]:
    path = snapshots.resolve_snapshot(spark, root, pinned)
    return json.loads(files.read_text(spark, f"{path}/feature_name_map.json"))
