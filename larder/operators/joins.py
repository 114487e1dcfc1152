"""Equi-joins for keyed documents and features.

Right sides are reduced to one row per key before a join, so a hot key can only
repeat on the left.  Spark's adaptive skew join then splits the hot partition of
an inner, left or semi join.  Where a key is known to be hot before the shuffle,
``join_salting_hot_keys`` spreads exactly those keys itself.  Full outer joins, which
Spark cannot split, only ever meet sides that are unique per key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import session
from larder.operators import aggregates, filters

_SALT = "__salt"


def full_outer_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Full outer join of two sides that are unique per key.

    Null keys do not match unless ``null_safe``.
    """
    if not null_safe:
        return left.join(right, list(keys), "full_outer")
    other = {k: f"__right_{k}" for k in keys}
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()])
    joined = left.join(right.withColumnsRenamed(other), same, "full_outer")
    values = {k: F.coalesce(k, o) for k, o in other.items()}
    return joined.withColumns(values).drop(*other.values())


def keep_with_positive(df: DataFrame, group: str, label: str = "label") -> DataFrame:
    """Rows of groups that hold at least one row with a positive label."""
    positive = df.filter(F.col(label) == 1).select(group).distinct()
    return df.join(positive, group, "left_semi")


def attach(df: DataFrame, attributes: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Left join of attributes that are unique per key: the row count stays."""
    return df.join(attributes, [keys] if isinstance(keys, str) else list(keys), "left")


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """Keys that hold more than ``1 / parts`` of all rows, with a split count.

    Fewer than ``parts`` keys can pass, so the result may be broadcast whatever
    the size of ``df``.  The count is a map-side combined aggregation of the key
    columns alone.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    share = F.col("__n") / total.cast("double")
    splits = F.ceil(share * parts).cast("int")
    return counts.filter(share > 1.0 / parts).select(*keys, splits.alias("__splits"))


def join_salting_hot_keys(
    df: DataFrame,
    unique: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    parts: int = 64,
    heat: DataFrame | None = None,
) -> DataFrame:
    """Left join against a side unique per key that spreads hot keys.

    A key with more than ``1 / parts`` of the rows is split by a hash of
    ``spread_by`` into as many pieces as it fills average partitions; only the
    right rows of such keys are repeated.  Other keys are joined as they are.

    Keys are counted on ``heat``, by default on ``df``.  Where ``df`` is the end
    of a long plan, pass a plain table whose keys are spread alike: it decides
    only how many pieces a key gets, never the result.  The list of hot keys,
    fewer than ``parts`` rows, is written once, so both sides read it and neither
    counts again.
    """
    hot = F.broadcast(session.materialise(hot_keys(df if heat is None else heat, keys, parts), "hot-keys"))
    piece = F.pmod(F.xxhash64(*spread_by), F.col("__splits").cast("bigint")).cast("int")
    left = (
        df.join(hot, list(keys), "left")
        .withColumn(_SALT, F.coalesce(piece, F.lit(0)))
        .drop("__splits")
    )
    right = (
        unique.join(hot, list(keys), "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__splits"), F.lit(1)) - 1)))
        .drop("__splits")
    )
    return left.join(right, [*keys, _SALT], "left").drop(_SALT)


def fill_with_mean(df: DataFrame, feature: DataFrame, key: str, field: str, mean: float | None = None) -> DataFrame:
    """Left join one feature; a missing value becomes the feature's global mean.

    Give the stored ``mean`` where there is one; it saves a pass over the feature.
    """
    fill = feature.agg(F.avg(field).alias("mean")).scalar() if mean is None else F.lit(mean)
    joined = attach(df, feature.select(key, field), key)
    return joined.withColumn(field, F.coalesce(F.col(field), fill))


def fill_with_zero(df: DataFrame, feature: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Left join features; missing values become 0."""
    return attach(df, feature.select(key, *fields), key).fillna(0, subset=list(fields))


def attach_general(df: DataFrame, general: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Attach general features on (user, item) without multiplying rows.

    The features are functions of the key, so any row of a key carries them;
    ``max`` per field picks one and lets Spark combine before the shuffle.
    """
    unique = general.groupBy(*keys).agg(*[F.max(f).alias(f) for f in fields])
    return attach(df, unique, keys)


def merge_documents(
    id_sets: Mapping[str, DataFrame], documents: Sequence[DataFrame], schema_of_empty: DataFrame | None = None
) -> DataFrame:
    """Documents of every id: id set left join document sets, null ids dropped.

    ``id_sets`` maps an id column to the set that defines its ids.  The first
    document set that has rows is laid under each id set in turn, the others are
    attached on all id columns.  Document sets are expected to be unique per id.
    """
    ids = list(id_sets)
    if not documents:
        documents = [schema_of_empty] if schema_of_empty is not None else []
    if not documents:
        if len(ids) != 1:
            raise ValueError("several id sets need at least one document set to relate them")
        return filters.drop_null_ids(next(iter(id_sets.values())), ids)
    # only a set with rows can relate several ids; a single id needs none
    first = next((n for n, docs in enumerate(documents) if len(ids) > 1 and not docs.isEmpty()), 0)
    others = [docs for n, docs in enumerate(documents) if n != first]
    merged = reduce(lambda docs, kv: kv[1].join(docs, kv[0], "left"), id_sets.items(), documents[first])
    merged = reduce(lambda docs, more: docs.join(more, ids, "left"), others, merged)
    return filters.drop_null_ids(merged, ids)


def restrict_to_id_sets(docs: DataFrame, id_sets: Mapping[str, DataFrame]) -> DataFrame:
    """Documents whose ids occur in every id set; id-set columns are kept.

    A bare id set becomes a semi join: it cannot multiply documents.
    """
    for column, ids in id_sets.items():
        if ids.columns == [column]:
            docs = docs.join(ids, column, "left_semi")
        else:
            docs = ids.join(docs, column, "inner")
    return filters.drop_null_ids(docs, list(id_sets))


def lookup(
    df: DataFrame, table: DataFrame, keys: Mapping[str, str], fields: Mapping[str, str], unique: bool = False
) -> DataFrame:
    """Fetch fields of a table by one or several keys.

    ``keys`` maps a column of ``df`` to a column of ``table``; ``fields`` maps a
    table field to its new name.  One row per key is taken from the table; say
    ``unique`` where its keys are known to be, which saves that aggregation.
    """
    renamed = {f"__k{i}": t for i, t in enumerate(keys.values())}
    picked = table.select(*[F.col(t).alias(k) for k, t in renamed.items()], *[F.col(f).alias(n) for f, n in fields.items()])
    single = picked if unique else aggregates.one_row_per_key(picked, list(renamed), list(fields.values()))
    condition = reduce(lambda a, b: a & b, [F.col(c) == F.col(k) for c, k in zip(keys, renamed)])
    return df.join(single, condition, "left").drop(*renamed)


def match_on_conditions(current: DataFrame, delta: DataFrame, conditions: Sequence[str], prefix: str = "delta_") -> DataFrame:
    """Current documents beside the delta rows that agree on all conditions.

    Both sides must be unique per condition tuple; ``matched`` tells
    ``both``, ``current`` and ``delta`` apart.
    """
    values = [c for c in delta.columns if c not in conditions]
    left = current.withColumn("__c", F.lit(1))
    right = delta.select(*conditions, *[F.col(c).alias(f"{prefix}{c}") for c in values], F.lit(1).alias("__d"))
    joined = left.join(right, list(conditions), "full_outer")
    kind = F.when(F.col("__c").isNull(), "delta").when(F.col("__d").isNull(), "current").otherwise("both")
    return joined.withColumn("matched", kind).drop("__c", "__d")


def default_parts(df: DataFrame) -> int:
    """A split count for hot keys that follows the configured shuffle width."""
    width: Any = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return max(8, 2 ** math.ceil(math.log2(int(width))))
