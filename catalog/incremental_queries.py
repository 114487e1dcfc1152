"""Change detection, upserts, aggregating merges, streaming."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import query, table
from larder import session
from larder.functions import text
from larder.operators import merge
from larder.sources import snapshots
from larder.sources.keyed import KeyedTable
from larder.sources.serving import ServingTable
from larder.streaming import incremental

_END, _DELTA = "2024-01-30 18:00:00", 14_400
_CHANGED = f"""changed as (select distinct user_id from events
  where ts >= timestamp '{_END}' - interval {_DELTA} second and ts < timestamp '{_END}')"""


def _changed(spark, sf_dir):
    end = F.lit(_END).cast("timestamp_ntz")
    return merge.changed_keys(table(spark, sf_dir, "events"), "user_id", "ts", end, _DELTA)


@query("changed_keys", f"with {_CHANGED} select user_id from changed")
def changed_keys(spark, sf_dir):
    """Ids changed in a window, saved as a snapshot and read back."""
    root = session.scratch_path(spark, "changed")
    snapshots.write_parquet(_changed(spark, sf_dir), root)
    return snapshots.read_parquet(spark, root)


@query(
    "change_trigger",
    f"""with {_CHANGED} select 'window' as name, (select count(*) from changed) > 0 as triggered
union all select 'none', (select count(*) from events where ts > timestamp '2030-01-01') > 0""",
)
def change_trigger(spark, sf_dir):
    changed = _changed(spark, sf_dir).agg(F.count("*").alias("n"))
    none = table(spark, sf_dir, "events").filter("ts > '2030-01-01'").agg(F.count("*").alias("n"))
    first = merge.change_trigger(changed, "n").withColumn("name", F.lit("window"))
    return first.unionByName(merge.change_trigger(none, "n").withColumn("name", F.lit("none")))


@query(
    "load_by_keys",
    f"with {_CHANGED} select c_custkey as user_id, c_name, c_acctbal from customer where c_custkey in (select user_id from changed)",
)
def load_by_keys(spark, sf_dir):
    """The changed ids' documents from a keyed table, of which only their directories are read."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_acctbal")
    keyed = KeyedTable(spark, session.scratch_path(spark, "customers"), ["user_id"]).write(customers, buckets=64)
    return keyed.load(_changed(spark, sf_dir))


@query(
    "load_by_keys_scan",
    f"with {_CHANGED} select c_custkey as user_id, c_name, c_acctbal from customer where c_custkey in (select user_id from changed)",
)
def load_by_keys_scan(spark, sf_dir):
    """The same from a table of any layout."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_acctbal")
    return merge.load_by_keys(customers, _changed(spark, sf_dir), "user_id")


@query(
    "serving_load",
    f"""with {_CHANGED} select c_custkey as user_id, case when c_custkey % 3 = 0 then 'new' else c_name end as c_name,
       case when c_custkey % 3 <> 0 then c_acctbal end as c_acctbal
from customer where c_custkey in (select user_id from changed)""",
)
def serving_load(spark, sf_dir):
    """Documents of some ids from a serving table that was compacted once and has changes beside it."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_acctbal")
    served = ServingTable(spark, session.scratch_path(spark, "served"), ["user_id"])
    served.publish(served.write(customers, "full"))
    newer = customers.filter("user_id % 3 = 0").select("user_id", F.lit("new").alias("c_name"))
    served.write(newer.filter("user_id % 2 = 0"), "incremental")
    served.compact()
    served.write(newer.filter("user_id % 2 = 1"), "incremental")
    return served.load(_changed(spark, sf_dir))


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(
    "upsert_partial",
    """select o_orderkey,
       case when o_orderstatus = 'P' then null when o_orderkey % 3 = 0 then 'X' else o_orderstatus end as o_orderstatus,
       case when o_orderkey % 4 = 0 then null else round(o_totalprice, 2) end as o_totalprice,
       case when o_orderstatus = 'P' or o_orderkey % 3 = 0 then 'delta' end as source
from orders where o_orderkey % 4 <> 0 or o_orderstatus = 'P' or o_orderkey % 3 = 0""",
)
def upsert_partial(spark, sf_dir):
    """Given fields overwrite, null included; the price is never supplied."""
    orders = _orders(spark, sf_dir)
    base = orders.filter("o_orderkey % 4 <> 0").select("o_orderkey", "o_orderstatus", "o_totalprice")
    status = F.when(F.col("o_orderstatus") != "P", F.lit("X"))
    delta = orders.filter("o_orderstatus = 'P' or o_orderkey % 3 = 0").select(
        "o_orderkey", status.alias("o_orderstatus"), F.lit("delta").alias("source")
    )
    return merge.upsert_partial(base, delta, ["o_orderkey"])


@query(
    "upsert_replace",
    """select o_orderkey, case when o_orderstatus = 'P' then 'Z' else o_orderstatus end as o_orderstatus,
       case when o_orderstatus <> 'P' then o_totalprice end as o_totalprice,
       case when o_orderstatus <> 'P' then o_orderpriority end as o_orderpriority
from orders where o_orderkey % 4 <> 0 or o_orderstatus = 'P'""",
)
def upsert_replace(spark, sf_dir):
    """Whole documents are replaced: fields the delta lacks become null."""
    orders = _orders(spark, sf_dir)
    delta = orders.filter("o_orderstatus = 'P'").select("o_orderkey", F.lit("Z").alias("o_orderstatus"))
    return merge.upsert_replace(orders.filter("o_orderkey % 4 <> 0"), delta, ["o_orderkey"])


@query(
    "append_no_id",
    """select o_orderstatus, count(*) as n, count(note) as notes from
(select o_orderstatus, null as note from orders union all select o_orderstatus, 'again' from orders where o_totalprice > 200000) group by 1""",
)
def append_no_id(spark, sf_dir):
    """Documents without an id are appended, copies included."""
    served = ServingTable(spark, session.scratch_path(spark, "append"))
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice")
    served.publish(served.write(orders, "full"))
    served.write(orders.filter("o_totalprice > 200000").withColumn("note", F.lit("again")), "incremental")
    return served.read().groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count("note").alias("notes"))


@query(
    "full_vs_incremental",
    """select 'full' as step, count(*) as n, round(sum(o_totalprice), 2) as total from orders where o_orderkey % 2 = 0
union all select 'incremental', count(*), round(sum(o_totalprice), 2) from orders
union all select 'full again', count(*), round(sum(o_totalprice), 2) from orders where o_orderstatus = 'O'""",
)
def full_vs_incremental(spark, sf_dir):
    """A full build, an increment to it, and a full build that starts over."""
    served, orders = ServingTable(spark, session.scratch_path(spark, "modes"), ["o_orderkey"]), _orders(spark, sf_dir)

    def total(step):
        made = served.read().agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
        return made.withColumn("step", F.lit(step))

    served.publish(served.write(orders.filter("o_orderkey % 2 = 0"), "full"))
    steps = total("full")
    served.write(orders.filter("o_orderkey % 2 <> 0"), "incremental")
    steps = steps.unionByName(total("incremental"))
    served.publish(served.write(orders.filter("o_orderstatus = 'O'"), "full"))
    return steps.unionByName(total("full again"))


@query(
    "instant_fields",
    """with last as (select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
select user_id, props, json_extract_string(props, '$.k')::int as k, event_type, value from last""",
)
def instant_fields(spark, sf_dir):
    """Two domains take different fields of one set of changes."""
    last = merge.latest_change(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])
    domains = {"items": (["props"], {"props": "k int"}), "scores": (["event_type", "value"], {})}
    tables = {}
    for name, (fields, kinds) in domains.items():
        served = ServingTable(spark, session.scratch_path(spark, name), ["user_id"], "partial")
        base = last.select("user_id")
        served.publish(served.write(base, "full"))
        served.write(merge.instant_fields(last, "user_id", fields, kinds), "incremental")
        tables[name] = served.read()
    items = tables["items"].select("user_id", "props", F.col("props_json.k").alias("k"))
    return items.join(tables["scores"], "user_id")


_MERGE_SQL = """with cur as (select user_id, count(*) as n, max(value) as best, min(value) as least, max(ts) as seen
  from events where ts < timestamp '2024-01-20' and user_id % 3 <> 0 group by 1),
d as (select user_id, count(*) as n, max(value) as best, min(value) as least, max(ts) as seen
  from events where ts >= timestamp '2024-01-20' and user_id % 5 <> 0 group by 1)
select user_id, cast(coalesce(cur.n, 0) + coalesce(d.n, 0) as bigint) as n, greatest(cur.best, d.best) as best,
       least(cur.least, d.least) as least, coalesce(d.seen, cur.seen)::varchar as seen
from cur full outer join d using (user_id)"""


@query("merge_aggregate", _MERGE_SQL)
def merge_aggregate(spark, sf_dir):
    """Counts, extremes and last times of a delta merged into current documents."""
    events = table(spark, sf_dir, "events")

    def per_user(df):
        return df.groupBy("user_id").agg(
            F.count("*").alias("n"), F.max("value").alias("best"), F.min("value").alias("least"), F.max("ts").alias("seen")
        )

    current = per_user(events.filter("ts < '2024-01-20' and user_id % 3 <> 0"))
    delta = per_user(events.filter("ts >= '2024-01-20' and user_id % 5 <> 0"))
    rules = {"n": "sum", "best": "max", "least": "min", "seen": "last"}
    merged = merge.merge_aggregate(current, delta, ["user_id"], rules)
    return merged.withColumn("seen", F.col("seen").cast("string"))


@query(
    "pre_aggregate_delta",
    """select user_id, count(*) as n, max(value) as best, arg_max(event_type, (ts, event_id)) as last_type from events group by 1""",
)
def pre_aggregate_delta(spark, sf_dir):
    """Several delta rows per id are folded before a merge."""
    rows = table(spark, sf_dir, "events").select(
        "user_id", F.lit(1).alias("n"), F.col("value").alias("best"), F.col("event_type").alias("last_type"), "ts", "event_id"
    )
    return merge.pre_aggregate(rows, ["user_id"], {"n": "sum", "best": "max", "last_type": "last"}, ["ts", "event_id"])


@query(
    "merge_append",
    """select user_id, row_number() over (partition by user_id order by ts >= timestamp '2024-01-20', ts, event_id) as place, event_type as value
from events""",
)
def merge_append(spark, sf_dir):
    """Lists of event types kept as chunks; a later delta of many rows per user is appended."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    path = session.scratch_path(spark, "lists")
    for part, when in enumerate(("ts < '2024-01-20'", "ts >= '2024-01-20'")):
        made = merge.list_chunks(events.filter(when), ["user_id"], "event_type", ["ts", "event_id"], part, per_chunk=16)
        made.write.mode("append").parquet(path)
    values = merge.list_values(spark.read.parquet(path), ["user_id"])
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("part", "slice", "chunk", "place")).cast("bigint")
    return values.select("user_id", place.alias("place"), "value")


@query(
    "late_rows_aside",
    """with last as (select max(ts) as top from events)
select event_type, late, count(*) as n, count(distinct event_id) as ids from (
  select event_type, event_id, false as late from events
  union all select event_type, event_id, ts < top - interval 2 day from events, last where event_id % 3 = 0) group by all""",
)
def late_rows_aside(spark, sf_dir):
    """Events in time order, then a third of them again: those more than two days behind the newest go to a side table."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    path, out = session.scratch_path(spark, "late"), session.scratch_path(spark, "late-out")
    for rows in (events.filter("ts < '2024-01-16'"), events.filter("ts >= '2024-01-16'"), events.filter("event_id % 3 = 0")):
        rows.coalesce(1).write.mode("append").parquet(path)
    stream = incremental.change_stream(spark, path, events.schema, files_per_batch=1)
    incremental.run_to_end(incremental.split_late_stream(stream, "ts", 2 * 86_400, out, session.scratch_path(spark, "progress")))
    found = incremental.read_split(spark, out)
    return found.groupBy("event_type", "late").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


# --- streaming ------------------------------------------------------------


def _stream(spark, sf_dir, name):
    """The events as four files, one per micro-batch, in time order."""
    events = table(spark, sf_dir, "events")
    path = session.scratch_path(spark, name)
    events.repartitionByRange(4, "ts").write.parquet(path)
    return incremental.change_stream(spark, path, events.schema, files_per_batch=1)


@query(
    "incremental_upsert",
    """with last as (select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
select c_custkey as user_id, c_name, event_id, event_type, json_extract_string(props, '$.k')::int as k
from customer left join last on user_id = c_custkey""",
)
def incremental_upsert(spark, sf_dir):
    """Micro-batches upsert the last event per user; the result is the batch one."""
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    served = ServingTable(spark, session.scratch_path(spark, "upserts"), ["user_id"], "partial", ["ts", "event_id"])
    served.publish(served.write(base, "full"))
    schema = "k int"

    def transform(df):
        # Files of one stream may come in any order: the time decides, not the batch.
        return df.select("user_id", "event_id", "event_type", F.from_json("props", schema)["k"].alias("k"), "ts")

    query_ = incremental.upsert_stream(
        _stream(spark, sf_dir, "events"), served, session.scratch_path(spark, "progress"), transform
    )
    incremental.run_to_end(query_)
    served.compact()
    return served.read().drop("ts")


@query(
    "incremental_reload",
    f"""select c_custkey, c_name, c_mktsegment || '|' || c_nationkey as tags from customer
where c_custkey in (select user_id from events where event_type = 'purchase' and value > 100)""",
)
def incremental_reload(spark, sf_dir):
    """Changed ids, their documents read again, transformed, and replaced."""
    customers = table(spark, sf_dir, "customer")
    served = ServingTable(spark, session.scratch_path(spark, "reload"), ["c_custkey"])
    served.publish(served.write(customers.filter("c_custkey < 0").select("c_custkey"), "full"))
    stream = _stream(spark, sf_dir, "changes").filter("event_type = 'purchase' and value > 100")
    stream = stream.withColumnRenamed("user_id", "c_custkey")

    def transform(df):
        tags = F.concat_ws("|", "c_mktsegment", "c_nationkey")
        return df.select("c_custkey", "c_name", text.split_pipe(tags).alias("tags"))

    keyed = KeyedTable(spark, session.scratch_path(spark, "customers"), ["c_custkey"]).write(customers, buckets=64)
    query_ = incremental.reload_stream(stream, keyed, served, session.scratch_path(spark, "progress"), transform)
    incremental.run_to_end(query_)
    return served.read().withColumn("tags", F.array_join("tags", "|"))


@query(
    "incremental_aggregates",
    """select user_id, event_type, count(*) as n, round(sum(value), 4) as total, max(ts)::varchar as seen from events group by all""",
)
def incremental_aggregates(spark, sf_dir):
    """Partial aggregates per micro-batch, folded into per-key documents."""
    path = session.scratch_path(spark, "partials")
    made = {"n": F.count("*"), "total": F.sum("value"), "seen": F.max("ts")}
    query_ = incremental.aggregate_stream(
        _stream(spark, sf_dir, "events"), path, ["user_id", "event_type"], made, session.scratch_path(spark, "progress")
    )
    incremental.run_to_end(query_)
    rules = {"n": "sum", "total": "sum", "seen": "max"}
    folded = incremental.fold_aggregates(spark, path, ["user_id", "event_type"], rules)
    return folded.withColumns({"total": F.round("total", 4), "seen": F.col("seen").cast("string")})


@query(
    "late_data_policy",
    """with last as (select max(ts) as top from events),
more as (select event_id, event_type, ts from events
         union all select event_id + 1000000, event_type, ts from events, last where ts > top - interval 1 day)
select event_type, count(*) as n, count(distinct event_id) as ids from more group by 1""",
)
def late_data_policy(spark, sf_dir):
    """Three files in time order, copies in each, and copies of the newest; then a file of late rows.

    Of the last file, rows within two days of the newest event come in; older ones, whose ids are new and which no state
    could tell from fresh ones, are beyond the watermark and fall, as do copies of old rows.
    """
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    path, out = session.scratch_path(spark, "late"), session.scratch_path(spark, "late-out")
    late = events.withColumn("event_id", F.col("event_id") + 1_000_000)
    ends = [F.lit(f"2024-01-{day}").cast("timestamp_ntz") for day in (11, 21)]
    parts = [F.col("ts") < ends[0], (F.col("ts") >= ends[0]) & (F.col("ts") < ends[1]), F.col("ts") >= ends[1]]
    newest = events.agg(F.max("ts")).scalar()
    fresh, stale = F.col("ts") > newest - F.expr("interval 1 day"), F.col("ts") < newest - F.expr("interval 3 days")
    files_ = [events.filter(p).unionByName(events.filter(p)) for p in parts]
    files_.append(events.filter(fresh))  # rows are late by the watermark of the batch before: one more lets it arrive
    files_.append(late.filter(fresh | stale).unionByName(events.filter(stale)))
    for rows in files_:
        rows.coalesce(1).write.mode("append").parquet(path)
    stream = incremental.change_stream(spark, path, events.schema, files_per_batch=1)
    once = incremental.with_late_policy(stream, "ts", "2 days", ["event_id"]).select("event_id", "event_type")
    running = (
        once.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", session.scratch_path(spark, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    incremental.run_to_end(running)
    kept = spark.read.parquet(out)
    return kept.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


@query(
    "serving_many_writers",
    """select o_orderkey, case when o_orderkey % 4 = 0 then 'B' when o_orderkey % 3 = 0 then 'A'
       when o_orderkey % 5 = 0 then 'M' else o_orderstatus end as o_orderstatus,
       case when o_orderkey % 4 = 0 then 3 when o_orderkey % 3 = 0 then 2 when o_orderkey % 5 = 0 then 1 else 0 end as seq
from orders""",
)
def serving_many_writers(spark, sf_dir):
    """A manual increment and two streams write to one table; all their batches are numbered from 0."""
    served = ServingTable(spark, session.scratch_path(spark, "writers"), ["o_orderkey"], order=["seq"])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    served.publish(served.write(orders.withColumn("seq", F.lit(0)), "full"))

    def changed(every, status, seq):
        rows = orders.filter(F.col("o_orderkey") % every == 0)
        return rows.withColumns({"o_orderstatus": F.lit(status), "seq": F.lit(seq)})

    streams = []
    for every, status, seq in ((4, "B", 3), (3, "A", 2)):
        path = session.scratch_path(spark, "changes")
        rows = changed(every, status, seq)
        rows.repartition(2, "o_orderkey").write.parquet(path)
        stream = incremental.change_stream(spark, path, rows.schema, files_per_batch=1)
        streams.append(incremental.upsert_stream(stream, served, session.scratch_path(spark, "progress")))
    served.write(changed(5, "M", 1), "incremental")
    for running in streams:
        incremental.run_to_end(running)
    return served.read()
