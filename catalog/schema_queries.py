"""Schema operators, each exercised on rows of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import query, table
from larder import session
from larder.sources import schemas, snapshots

_TYPES_SQL = """with shape as (select json_group_structure(to_json(r)) as s
  from (select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, user_id, event_type, value, props from events) r),
fields as (select unnest(json_keys(s)) as field, s from shape)
select field, case json_extract_string(s, '$.' || field) when 'VARCHAR' then 'string' when 'DOUBLE' then 'double'
       else 'bigint' end as type from fields"""


def _as_json(df):
    return df.select(F.to_json(F.struct("*")).alias("record"))


@query("infer_schema", _TYPES_SQL)
def infer_schema(spark, sf_dir):
    """Schema of a table of JSON texts, merged over all rows."""
    inferred = schemas.infer_json_schema(_as_json(table(spark, sf_dir, "events")), "record")
    return schemas.schema_frame(spark, inferred).select("field", "type")


@query(
    "infer_predefined",
    _TYPES_SQL.replace("else 'bigint' end", "else case field when 'user_id' then 'double' else 'bigint' end end"),
)
def infer_predefined(spark, sf_dir):
    records = _as_json(table(spark, sf_dir, "events"))
    inferred = schemas.infer_json_schema(records, "record", {"user_id": T.DoubleType()})
    return schemas.schema_frame(spark, inferred).select("field", "type")


@query("infer_nested", "select event_id, json_extract_string(props, '$.k')::bigint as k from events")
def infer_nested(spark, sf_dir):
    """The type of a JSON text column is inferred, then used to nest it."""
    events = table(spark, sf_dir, "events")
    kind = schemas.infer_json_schema(events, "props")
    return schemas.nest_json_columns(events, {"props": kind}).select("event_id", F.col("props.k").alias("k"))


@query(
    "normalize_values",
    """select event_id, json_extract_string(props, '$.k')::bigint as k, strftime(ts, '%Y-%m-%d') as day,
       hour(ts)::varchar || ':' || minute(ts)::varchar as short_time, strftime(ts, '%H:%M:%S') as long_time
from events""",
)
def normalize_values(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = schemas.normalize_values(events, {"props": "k bigint"})
    return rows.select(
        "event_id",
        "props.k",
        F.to_date("ts").cast("string").alias("day"),
        schemas.time_text(F.col("ts")).alias("short_time"),
        schemas.time_text(F.col("ts"), "HH:mm:ss").alias("long_time"),
    )


@query(
    "merge_schemas",
    """select * from (values (0, 'id', 'bigint'), (1, 'name', 'string'), (2, 'amount', 'double'), (3, 'day', 'timestamp_ntz'))
  s(position, field, type),
(select count(*) as n from (select c_custkey from customer union all select o_orderkey from orders))""",
)
def merge_schemas(spark, sf_dir):
    """Two document tables read back under their merged schema."""
    root = session.scratch_path(spark, "merged")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").cast("float").alias("amount")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("day")
    )
    merged = schemas.merge_schemas(customers.schema, orders.schema)
    for name, rows in (("a", customers), ("b", orders)):
        snapshots.write_json(rows, root, f"2024_{name}")
    rows = spark.read.schema(merged).json([f"{root}/2024_a", f"{root}/2024_b"])
    shape = schemas.schema_frame(spark, rows.schema)
    total = rows.filter("id is not null").agg(F.count("*").alias("n")).scalar()
    return shape.withColumn("n", total)


@query(
    "register_schema",
    """select event_type, count(*) as n, round(sum(value), 2) as total, cast(sum(user_id) as bigint) as users
from events group by 1""",
)
def register_schema(spark, sf_dir):
    """Create, skip, update, merge registered schemas; read rows with the last."""
    root, events = session.scratch_path(spark, "schemas"), table(spark, sf_dir, "events")
    part = events.select("event_id", "event_type").schema
    assert schemas.register_schema(spark, root, "events", part, "create", "20240101_000000_000000")
    assert not schemas.register_schema(spark, root, "events", events.schema, "create", "20240102_000000_000000")
    assert schemas.register_schema(spark, root, "events", events.select("event_type", "value").schema, "update", "20240103_000000_000000")
    assert schemas.register_schema(spark, root, "users", events.select("event_id", "user_id").schema, "create")
    assert schemas.register_merged(spark, root, "all", ["events", "users"], "create")
    snapshots.write_json(events, f"{root}/rows")
    rows = snapshots.read_json(spark, f"{root}/rows", schemas.registered_schema(spark, root, "all"))
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"), F.sum("user_id").alias("users")
    )


@query(
    "conform_projection",
    "select c_custkey, c_name, 'web' as channel, 3::bigint as priority, 0.5::double as boost from customer",
)
def conform_projection(spark, sf_dir):
    wanted = ["c_custkey", "c_name", "c_phone"]
    return schemas.conform(table(spark, sf_dir, "customer"), wanted, {"channel": "web", "priority": 3, "boost": 0.5})


@query("decimal_to_double", "select o_orderkey, o_totalprice, round(o_totalprice, 1) as rounded from orders")
def decimal_to_double(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")
    )
    rows = orders.withColumn("rounded", F.round(F.col("o_totalprice").cast("double"), 1).cast("decimal(18,1)"))
    return schemas.decimals_to_double(rows)


_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _feature_sql(names):
    return "\nunion all ".join(
        f"select {i} as ordinal, '{n}' as name, round(sum({c}), 2) as total from lineitem"
        for i, (n, c) in enumerate(zip(names, _FEATURES))
    )


def _feature_frame(df, names):
    sums = df.agg(*[F.round(F.sum(n), 2).alias(n) for n in names])
    rows = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(n).alias("name"), F.col(n).alias("total")) for i, n in enumerate(names)])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


_KEYS, _LABEL, _EXTRAS = ["l_orderkey", "l_linenumber"], "l_returnflag", ["l_partkey", "l_suppkey", "l_linestatus", "l_shipdate"]


@query("feature_names", _feature_sql(_FEATURES))
def feature_names(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return _feature_frame(lines, schemas.feature_names(lines.columns, _KEYS, _LABEL, _EXTRAS))


@query("feature_name_map", _feature_sql([f"f{i}" for i in range(len(_FEATURES))]))
def feature_name_map(spark, sf_dir):
    """The map is stored with the training schema and reused by a reader."""
    root, lines = session.scratch_path(spark, "feature-map"), table(spark, sf_dir, "lineitem")
    names = schemas.feature_names(lines.columns, _KEYS, _LABEL, _EXTRAS)
    schemas.save_feature_map(spark, root, snapshots.snapshot_now(), schemas.feature_name_map(names), lines.select(*names).schema)
    mapping = schemas.load_feature_map(spark, root)
    return _feature_frame(schemas.rename_features(lines, mapping), [mapping[n] for n in names])


@query("cast_declared_schema", "select o_orderkey::varchar as o_orderkey, round(o_totalprice)::bigint as o_totalprice, null::varchar as note from orders")
def cast_declared_schema(spark, sf_dir):
    """A read cast to its declared schema; fields the source lacks are null."""
    orders = table(spark, sf_dir, "orders").withColumn("o_totalprice", F.round("o_totalprice"))
    declared = T.StructType.fromDDL("o_orderkey string, o_totalprice bigint, note string")
    return schemas.cast_to(orders, declared)


