"""Keyed merges: change detection, upserts and aggregating merges.

Every merge meets sides that are unique per id, so the full outer joins carry no
skew.  Pass a delta with several rows per id through ``latest_change`` or
``pre_aggregate`` first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import nested
from larder.operators import aggregates


def in_window(column: str, end: Column, delta_seconds: int) -> Column:
    """``end - delta <= column < end``."""
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(delta_seconds)))
    return (F.col(column) >= end - span) & (F.col(column) < end)


def changed_keys(df: DataFrame, key: str, updated: str, end: Column, delta_seconds: int) -> DataFrame:
    """Distinct ids changed in the window before ``end``."""
    return df.filter(in_window(updated, end, delta_seconds)).select(key).distinct()


def change_trigger(counts: DataFrame, column: str) -> DataFrame:
    """One boolean: exactly one row, holding a number greater than 0."""
    one_positive = (F.count("*") == 1) & (F.coalesce(F.max(column), F.lit(0)) > 0)
    return counts.agg(one_positive.alias("triggered"))


def load_by_keys(documents: DataFrame, keys: DataFrame, id_column: str) -> DataFrame:
    """Full documents of the changed ids."""
    return documents.join(keys.select(id_column), id_column, "left_semi")


def latest_change(delta: DataFrame, ids: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per id of a delta with several changes of one document."""
    return aggregates.latest_per_key(delta, ids, order)


def not_older(base: DataFrame, delta: DataFrame, ids: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Delta rows that are not older than the document they would change."""
    known = base.select(*ids, F.struct(*order).alias("__known"))
    current = F.col("__known").isNull() | (F.struct(*order) >= F.col("__known"))
    return delta.join(known, list(ids), "left").filter(current).drop("__known")


def _side_by_side(base: DataFrame, delta: DataFrame, ids: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    base_fields = [c for c in base.columns if c not in ids]
    delta_fields = [c for c in delta.columns if c not in ids]
    left = base.select(*ids, F.struct(F.lit(True).alias("__present"), *base_fields).alias("__b"))
    right = delta.select(*ids, F.struct(F.lit(True).alias("__present"), *delta_fields).alias("__d"))
    return left.join(right, list(ids), "full_outer"), base_fields, delta_fields


def upsert_partial(base: DataFrame, delta: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Update or insert by id: fields of the delta overwrite, null included;
    fields the delta does not have are kept."""
    joined, base_fields, delta_fields = _side_by_side(base, delta, ids)

    def value(field: str) -> Column:
        old = F.col(f"__b.{field}") if field in base_fields else F.lit(None)
        if field not in delta_fields:
            return old.alias(field)
        return F.when(F.col("__d").isNotNull(), F.col(f"__d.{field}")).otherwise(old).alias(field)

    added = [f for f in delta_fields if f not in base_fields]
    return joined.select(*ids, *[value(f) for f in [*base_fields, *added]])


def latest_fields(changes: DataFrame, ids: Sequence[str], order: Sequence[str], supplied: str) -> DataFrame:
    """Newest supplied value per id and field, wrapped in a one-field struct.

    ``supplied`` lists the fields a change gives.  A field no change gives is a
    null struct; a field given as null is a struct holding null.
    """
    fields = [c for c in changes.columns if c not in {*ids, supplied}]

    def newest(field: str) -> Column:
        given = F.when(F.array_contains(supplied, field), F.struct(*order))
        return F.max_by(F.struct(F.col(field).alias("v")), given).alias(field)

    return changes.groupBy(*ids).agg(*[newest(f) for f in fields])


def upsert_fields(base: DataFrame, latest: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Update or insert by id with the fields of ``latest_fields``."""
    joined, base_fields, fields = _side_by_side(base, latest, ids)

    def value(field: str) -> Column:
        if field not in fields:
            return F.col(f"__b.{field}").alias(field)
        old = F.col(f"__b.{field}") if field in base_fields else F.lit(None)
        new = F.col(f"__d.{field}")
        return F.when(new.isNotNull(), new["v"]).otherwise(old).alias(field)

    added = [f for f in fields if f not in base_fields]
    return joined.select(*ids, *[value(f) for f in [*base_fields, *added]])


def upsert_replace(base: DataFrame, delta: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Replace whole documents by id; a field the delta lacks becomes null."""
    kept = base.join(delta.select(*ids), list(ids), "left_anti")
    return kept.unionByName(delta, allowMissingColumns=True)


def append(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Plain append for documents without an id."""
    return base.unionByName(delta, allowMissingColumns=True)


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


_MERGE: dict[str, Callable[[Column, Column], Column]] = {
    "sum": _plus,
    "min": lambda a, b: F.least(a, b),
    "max": lambda a, b: F.greatest(a, b),
    "last": lambda a, b: F.coalesce(b, a),
    "overwrite": lambda a, b: b,
    "append": lambda a, b: F.coalesce(F.concat(a, b), a, b),
}


def pre_aggregate(delta: DataFrame, ids: Sequence[str], rules: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    """Fold several delta rows per id with the rules of ``merge_aggregate``.

    ``append`` of cells needs a delta that is already unique per id: gathering the rows
    of an id here would put a group of any size into one cell.  ``list_chunks`` appends
    any number of rows.
    """
    if "append" in rules.values():
        raise ValueError("append needs a delta that is unique per id")
    fold: dict[str, Callable[[str], Column]] = {
        "sum": F.sum,
        "min": F.min,
        "max": F.max,
        "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))),
        "overwrite": lambda c: F.max_by(c, F.struct(*order)),
    }
    return delta.groupBy(*ids).agg(*[fold[rule](c).alias(c) for c, rule in rules.items()])


#: Values of a list that one row holds, and slices of the order's range at most.
CHUNK_VALUES, MOST_SLICES = 1024, 1024


def _bounds_upto(bounds: Sequence, value: Column) -> Column:
    """How many of the ascending bounds are not above the value, by halving; none for null."""
    ends = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << n) for n in reversed(range(len(bounds).bit_length()))])

    def passed(at: Column, step: Column) -> Column:
        return F.when(F.get(ends, at + step - 1) <= value, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), passed)


def list_chunks(delta: DataFrame, ids: Sequence[str], value: str, order: Sequence[str], part: int, per_chunk: int = CHUNK_VALUES) -> DataFrame:
    """(ids, part, slice, chunk, values): the values of a delta with any number of rows per id, in order, as numbered rows.

    Lists are kept beside their documents as such rows, so ``append`` adds the rows of the delta under the next ``part`` and
    changes none: the list of an id is its chunks by part, slice and chunk.  Ids with many values are cut into slices of the
    order's range, the same for all ids, so the rows of one id are numbered by many tasks: as many slices as the longest list
    asks for, ``MOST_SLICES`` at most; beyond that slices grow.  A row finds its slice by halving.  The first column of
    ``order`` is a number, a date or a time; together its columns tell the rows of an id apart.
    """
    longest = delta.groupBy(*ids).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    slices = min(MOST_SLICES, max(1, -(-longest // (64 * per_chunk))))
    cuts = [n / slices for n in range(1, slices)]
    first = order[0]
    bounds = delta.agg(F.percentile_approx(first, cuts, 100 * slices)).first()[0] if cuts else []
    slice_ = _bounds_upto(bounds, F.col(first)) if bounds else F.lit(0)
    rows = delta.withColumn("slice", slice_).withColumn("__place", F.row_number().over(Window.partitionBy(*ids, "slice").orderBy(*order)) - 1)
    chunk = F.floor(F.col("__place") / per_chunk).alias("chunk")
    values = F.transform(F.array_sort(F.collect_list(F.struct("__place", F.col(value).alias("v")))), lambda e: e["v"])
    return rows.groupBy(*ids, F.lit(part).alias("part"), "slice", chunk).agg(values.alias("values"))


def list_values(chunks: DataFrame, ids: Sequence[str]) -> DataFrame:
    """(ids, part, slice, chunk, place, value): the values of lists one by one; they stand in the order of the four numbers."""
    return chunks.select(*ids, "part", "slice", "chunk", F.posexplode("values").alias("place", "value"))


def merge_aggregate(base: DataFrame, delta: DataFrame, ids: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """Combine a delta into current documents field by field.

    ``sum``, ``min`` and ``max`` skip nulls; ``last`` takes the delta value
    unless it is null; ``overwrite`` takes it in any case; ``append`` joins two
    lists.  Fields without a rule keep the current value.  Unmatched documents
    of either side are kept.
    """
    joined, base_fields, delta_fields = _side_by_side(base, delta, ids)

    def value(field: str) -> Column:
        old, new = F.col(f"__b.{field}"), F.col(f"__d.{field}")
        if field not in delta_fields:
            return old.alias(field)
        if field not in base_fields:
            return new.alias(field)
        both = _MERGE[rules[field]](old, new) if field in rules else old
        merged = F.when(F.col("__b").isNull(), new).when(F.col("__d").isNull(), old).otherwise(both)
        return merged.alias(field)

    added = [f for f in delta_fields if f not in base_fields]
    return joined.select(*ids, *[value(f) for f in [*base_fields, *added]])


def instant_fields(changes: DataFrame, id_column: str, fields: Sequence[str], json_fields: Mapping[str, str]) -> DataFrame:
    """Project the id and the chosen fields of one domain.

    ``json_fields`` maps fields to their nested type: where the text parses the
    parsed value is added as ``<field>_json`` and the text is kept beside it.
    """
    picked = changes.select(id_column, *fields)
    return picked.withColumns({f"{f}_json": nested.parse_json(f, t) for f, t in json_fields.items()})


def transform_fields(
    changes: DataFrame, id_column: str, transforms: Mapping[str, tuple[Sequence[str], Callable[..., Column]]]
) -> DataFrame:
    """n-to-1 transforms: ``{out: (inputs, fn)}`` where ``fn`` maps the input
    columns to one column and may be a pandas UDF."""
    made = [fn(*[F.col(c) for c in inputs]).alias(out) for out, (inputs, fn) in transforms.items()]
    return changes.select(id_column, *made)
