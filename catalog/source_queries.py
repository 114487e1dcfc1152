"""Sources, sinks, snapshots, serving tables, run state."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import bindings, query, table
from larder import session
from larder.operators import aggregates
from larder.sources import extract, manifest, snapshots
from larder.sources.serving import ServingTable

_ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("read_json_inferred", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def read_json_inferred(spark, sf_dir):
    root = session.scratch_path(spark, "orders")
    snapshots.write_json(table(spark, sf_dir, "orders"), root)
    return snapshots.read_json(spark, root).select(*_ORDER_FIELDS)


@query("read_json_schema", "select event_id, ts::varchar as ts, user_id, event_type, value, props from events")
def read_json_schema(spark, sf_dir):
    root, events = session.scratch_path(spark, "events"), table(spark, sf_dir, "events")
    snapshots.write_json(events, root)
    return snapshots.read_json(spark, root, events.schema).withColumn("ts", F.col("ts").cast("string"))


@query("read_parquet_latest", "select s_suppkey, s_name, 2 as run from supplier")
def read_parquet_latest(spark, sf_dir):
    """Two complete snapshots and an unfinished newer one."""
    root, rows = session.scratch_path(spark, "supplier"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    snapshots.write_parquet(rows.withColumn("run", F.lit(1)), root, "20240101_000000_000000")
    snapshots.write_parquet(rows.withColumn("run", F.lit(2)), root, "20240102_000000_000000")
    unfinished = rows.withColumn("run", F.lit(3)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    unfinished.parquet(f"{root}/20240103_000000_000000")
    return snapshots.read_parquet(spark, root)


@query("read_csv_feature", f"with {bindings.RATIO_SQL} select item_sid, round(positive_ratio, 9) as positive_ratio from ratio")
def read_csv_feature(spark, sf_dir):
    root = session.scratch_path(spark, "ratio")
    made = aggregates.positive_ratio(bindings.item_feedback(spark, sf_dir), "item_sid", "interaction")
    snapshots.write_csv(made.select("item_sid", "positive_ratio"), root)
    stored = snapshots.read_csv(spark, root, "item_sid bigint, positive_ratio double")
    return stored.withColumn("positive_ratio", F.round("positive_ratio", 9))


@query("write_csv_feature", f"with {bindings.RATIO_SQL} select count(*) as n, round(sum(positive_ratio), 6) as total from ratio")
def write_csv_feature(spark, sf_dir):
    root = session.scratch_path(spark, "ratio")
    made = aggregates.positive_ratio(bindings.item_feedback(spark, sf_dir), "item_sid", "interaction")
    snapshots.write_csv(made.select("item_sid", "positive_ratio"), root)
    stored = snapshots.read_csv(spark, root, "item_sid bigint, positive_ratio double")
    return stored.agg(F.count("*").alias("n"), F.round(F.sum("positive_ratio"), 6).alias("total"))


_EXTRACT = """select o.o_custkey, count(*) as n, round(sum(o.o_totalprice), 2) as spent
from {orders} o where o.o_orderdate >= :start_date and o.o_orderdate < :end_date group by o.o_custkey"""


def _extract_sql(condition: str) -> str:
    return f"select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as spent from orders where {condition} group by 1"


@query("src_query_extract", _extract_sql("o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1998-01-01'"))
def src_query_extract(spark, sf_dir):
    """A query over the warehouse tables, landed as JSON and read back."""
    bounds = extract.date_parameters(datetime(1996, 1, 1), datetime(1998, 1, 1))
    orders = {"orders": table(spark, sf_dir, "orders")}
    return extract.extract_query(spark, _EXTRACT, orders, session.scratch_path(spark, "extract"), bounds)


@query(
    "query_template",
    """select count(*) as n, count(distinct user_id) as users, round(sum(value), 2) as total
from events where ts >= timestamp '2024-01-20 12:00:00' - interval 172800 second and ts < timestamp '2024-01-20 12:00:00'""",
)
def query_template(spark, sf_dir):
    """Run time and delta as bound parameters of a change query."""
    text = """select count(*) as n, count(distinct user_id) as users, round(sum(value), 2) as total from {events}
    where ts >= cast(:run_datetime as timestamp_ntz) - make_dt_interval(0, 0, 0, :delta_seconds)
      and ts < cast(:run_datetime as timestamp_ntz)"""
    parameters = extract.window_parameters(datetime(2024, 1, 20, 12), 172_800)
    return extract.run_query(spark, text, {"events": table(spark, sf_dir, "events")}, parameters)


_LAND_SQL = """select l_returnflag, l_linestatus, count(*) as n, cast(sum(l_orderkey) as bigint) as keys,
       round(sum(l_extendedprice), 2) as price, min(l_shipdate)::varchar as first_ship from lineitem group by all"""


@query("land_batches", _LAND_SQL)
def land_batches(spark, sf_dir):
    landed = extract.land(table(spark, sf_dir, "lineitem"), session.scratch_path(spark, "land"))
    return landed.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.sum("l_orderkey").alias("keys"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.min("l_shipdate").cast("string").alias("first_ship"),
    )


@query(
    "land_nested",
    """select event_type, count(*) as n, cast(sum(json_extract_string(props, '$.k')::bigint) as bigint) as keys
from events group by 1""",
)
def land_nested(spark, sf_dir):
    """Objects in text land nested, by inferred types."""
    landed = extract.land(table(spark, sf_dir, "events"), session.scratch_path(spark, "land"), json_columns=["props"])
    return landed.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("props.k").cast("bigint").alias("keys"))


def _add_net(batch: pd.DataFrame, rate: float) -> pd.DataFrame:
    return batch.assign(net=batch["l_extendedprice"] * (1 - batch["l_discount"]) * rate)


@query(
    "land_with_callback",
    """select l_returnflag, count(*) as n, round(sum(l_extendedprice * (1 - l_discount) * 0.5), 2) as net,
       count(*) filter (where l_quantity > 25) as large from lineitem group by 1""",
)
def land_with_callback(spark, sf_dir):
    """Two callbacks: one over Arrow batches, one over the DataFrame."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice", "l_discount")
    schema = T.StructType([*lines.schema.fields, T.StructField("net", T.DoubleType())])
    over_batches = extract.batch_callback(_add_net, schema, rate=0.5)

    def enrich(df):
        return over_batches(df).withColumn("large", F.col("l_quantity") > 25)

    landed = extract.land(lines, session.scratch_path(spark, "land"), callback=enrich)
    return landed.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.sum("net"), 2).alias("net"), F.count_if("large").alias("large")
    )


@query("write_parquet_snapshot", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def write_parquet_snapshot(spark, sf_dir):
    path = snapshots.write_parquet(table(spark, sf_dir, "customer"), session.scratch_path(spark, "customer"))
    return spark.read.parquet(path)


@query("write_json_snapshot", "select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def write_json_snapshot(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    path = snapshots.write_json(parts, session.scratch_path(spark, "part"))
    return spark.read.schema(parts.schema).json(path)


@query(
    "feature_info",
    f"""with {bindings.RATIO_SQL}
select 'mean' as kind, 'positive_ratio' as name, round(avg(positive_ratio), 8) as mean from ratio
union all select distinct 'badge', event_type, null from events""",
)
def feature_info(spark, sf_dir):
    """Mean of a feature and the list of categories, stored beside the feature."""
    root = session.scratch_path(spark, "info")
    made = aggregates.positive_ratio(bindings.item_feedback(spark, sf_dir), "item_sid", "interaction")
    snapshots.write_json(snapshots.mean_info(made, ["positive_ratio"]), f"{root}/positive_ratio.info")
    badges = aggregates.distinct_categories(bindings.user_badges(spark, sf_dir), "badge_type")
    snapshots.write_json(badges, f"{root}/badges.info")
    means = snapshots.read_json(spark, f"{root}/positive_ratio.info", "feature string, mean double")
    names = snapshots.read_json(spark, f"{root}/badges.info", "badge string")
    return means.select(F.lit("mean").alias("kind"), F.col("feature").alias("name"), F.round("mean", 8).alias("mean")).unionByName(
        names.select(F.lit("badge").alias("kind"), F.col("badge").alias("name"), F.lit(None).cast("double").alias("mean"))
    )


@query(
    "resolve_snapshot",
    """select 'latest' as pick, o_orderpriority, count(*) as n from orders group by all
union all select 'pinned', o_orderpriority, count(*) from orders where o_orderdate < timestamp '1998-01-01' group by all""",
)
def resolve_snapshot(spark, sf_dir):
    root, orders = session.scratch_path(spark, "orders"), table(spark, sf_dir, "orders")
    snapshots.write_parquet(orders.filter("o_orderdate < '1998-01-01'"), root, "20240101_000000_000000")
    snapshots.write_parquet(orders, root, "20240201_000000_000000")

    def counted(name, pinned):
        rows = snapshots.read_parquet(spark, root, pinned).groupBy("o_orderpriority").agg(F.count("*").alias("n"))
        return rows.withColumn("pick", F.lit(name))

    return counted("latest", None).unionByName(counted("pinned", "20240101_000000_000000"))


@query(
    "retain_snapshots",
    """select '2024' || lpad(m::varchar, 2, '0') || '01_000000_000000' as snapshot, count(*) as n
from orders, range(3, 5) r(m) where year(o_orderdate) <= 1994 + m group by m""",
)
def retain_snapshots(spark, sf_dir):
    """Four snapshots of a growing table; the two newest stay."""
    root, orders = session.scratch_path(spark, "orders"), table(spark, sf_dir, "orders")
    for month in range(1, 5):
        upto = orders.filter(F.year("o_orderdate") <= 1994 + month).select("o_orderkey")
        snapshots.write_parquet(upto, root, f"2024{month:02d}01_000000_000000")
    snapshots.retain_snapshots(spark, root, 2)
    kept = spark.read.option("basePath", root).parquet(f"{root}/*_000000")
    name = F.element_at(F.split(F.input_file_name(), "/"), -2)
    return kept.groupBy(name.alias("snapshot")).agg(F.count("*").alias("n"))


@query(
    "publish_pointer",
    """select 'v2' as version, o_orderstatus, count(*) as n from orders where o_totalprice > 1000 group by all
union all select 'v3', o_orderstatus, count(*) from orders group by all""",
)
def publish_pointer(spark, sf_dir):
    """Readers follow the pointer: v2 until v3 is published, v1 is then dropped."""
    served = ServingTable(spark, session.scratch_path(spark, "orders"), ["o_orderkey"])
    orders = table(spark, sf_dir, "orders")

    def published(version):
        rows = served.read().groupBy("o_orderstatus").agg(F.count("*").alias("n"))
        return rows.withColumn("version", F.lit(version))

    served.publish(served.write_version(orders.filter("o_totalprice > 50000"), "v1"), keep=2)
    served.publish(served.write_version(orders.filter("o_totalprice > 1000"), "v2"), keep=2)
    served.write_version(orders, "v3")
    before = published(served.published())
    served.publish("v3", keep=2)
    return before.unionByName(published(served.published()))


@query(
    "run_manifest",
    """select 'load-' || y::varchar as run_id, y::varchar || '0101_000000_000000' as start_date,
       (y + 2)::varchar || '0101_000000_000000' as end_date,
       (select count(*) from orders where year(o_orderdate) >= y and year(o_orderdate) < y + 2) as n
from (values (1995), (1997), (1999)) t(y)""",
)
def run_manifest(spark, sf_dir):
    """Three loads, each starting where the recorded previous one ended."""
    root, orders = session.scratch_path(spark, "runs"), table(spark, sf_dir, "orders")
    first = "19950101_000000_000000"
    for year in (1995, 1997, 1999):
        start = manifest.previous_end_value(spark, root, "load", "orders")
        start = first if start == manifest.DEFAULT_START else start
        end = f"{year + 2}0101_000000_000000"
        body = {"start_date": start, "end_date": end}
        manifest.record_run(spark, root, "load", f"load-{year}", end, "orders", body)
    runs = manifest.read_runs(spark, root).select(
        "run_id",
        F.get_json_object("body", "$.start_date").alias("start_date"),
        F.get_json_object("body", "$.end_date").alias("end_date"),
    )
    yearly = orders.groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    year = lambda c: F.substring(c, 1, 4).cast("int")
    # a run names the years it loaded, so the join is one of equal years
    runs = runs.withColumn("y", F.explode(F.sequence(year("start_date"), year("end_date") - 1)))
    return runs.join(yearly, "y").groupBy("run_id", "start_date", "end_date").agg(F.sum("n").alias("n"))


@query(
    "write_serving_table",
    """select o_orderkey, case when o_orderstatus = 'P' then 'Z' else o_orderstatus end as o_orderstatus,
       round(case when o_orderstatus = 'P' then o_totalprice * 2 else o_totalprice end, 2) as o_totalprice
from orders""",
)
def write_serving_table(spark, sf_dir):
    """A full version, then an incremental batch replacing documents by id."""
    served = ServingTable(spark, session.scratch_path(spark, "orders"), ["o_orderkey"])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    served.publish(served.write(orders.filter("o_orderstatus <> 'F'"), "full"))
    served.write(orders.filter("o_orderstatus = 'F'"), "incremental")
    changed = orders.filter("o_orderstatus = 'P'").withColumns(
        {"o_orderstatus": F.lit("Z"), "o_totalprice": F.col("o_totalprice") * 2}
    )
    served.write(changed, "incremental")
    return served.read().withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("snapshot_category_slices", "select lang, count(*) as n, cast(sum(n_chars) as bigint) as chars from documents group by 1")
def snapshot_category_slices(spark, sf_dir):
    """A text-length table sliced by language; each slice is read by its path."""
    root = session.scratch_path(spark, "slices")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    snapshots.write_parquet(docs, root, partition_by=["lang"])
    return snapshots.read_parquet(spark, root).groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


