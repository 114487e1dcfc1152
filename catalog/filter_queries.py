"""Projections, filters, predicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog import bindings, query, table
from larder import session
from larder.operators import filters
from larder.plans import labels
from larder.sources import schemas


@query("filter_condition", "select event_id, user_id, value from events where event_type in ('view', 'click') and value > 50")
def filter_condition(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return filters.where(events, "event_type in ('view', 'click') and value > 50").select("event_id", "user_id", "value")


@query(
    "filter_half_open",
    """select event_id, ts::varchar as ts from events
where ts >= timestamp '2024-01-10 06:30:00' and ts < timestamp '2024-01-12 00:00:00'""",
)
def filter_half_open(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    rows = filters.between_half_open(events, "ts", datetime(2024, 1, 10, 6, 30), datetime(2024, 1, 12))
    return rows.withColumn("ts", F.col("ts").cast("string"))


@query(
    "dropna_ids",
    """select c_custkey, u as user_id, n from customer
join (select user_id as u, count(*) as n from events where event_type = 'purchase' group by 1) on u = c_custkey""",
)
def dropna_ids(spark, sf_dir):
    buyers = table(spark, sf_dir, "events").filter("event_type = 'purchase'").groupBy("user_id").agg(F.count("*").alias("n"))
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    joined = customers.join(buyers, F.col("c_custkey") == F.col("user_id"), "left")
    return filters.drop_null_ids(joined, ["c_custkey", "user_id"])


@query(
    "rename_keys",
    "select user_id as user_account_sid, event_id as item_account_sid, value from events",
)
def rename_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return filters.rename_keys(events, {"user_id": "user_account_sid", "event_id": "item_account_sid"})


@query(
    "null_flag_filter",
    f"""with {bindings.labeled_sql(1.0)}
select case when r is null then 'passed' else 'matched' end as side, count(*) as n,
       count(distinct user_account_sid) as users from paired group by 1""",
)
def null_flag_filter(spark, sf_dir):
    pairs = labels.pair_requests(bindings.interaction_log(spark, sf_dir), bindings.label_spec(1.0))
    sides = [("passed", filters.passed(pairs)), ("matched", filters.matched(pairs))]
    counted = [
        rows.agg(F.count("*").alias("n"), F.count_distinct("user_account_sid").alias("users")).withColumn("side", F.lit(side))
        for side, rows in sides
    ]
    return counted[0].unionByName(counted[1])


@query(
    "assert_no_nulls",
    """with d as (select c_custkey, n, total, case when n > 60 then 'nan'::double else total / n end as mean from customer
  left join (select user_id, count(*) as n, sum(value) as total from events group by 1) on user_id = c_custkey)
select 'c_custkey' as "column", count(*) filter (where c_custkey is null) as null_count from d
union all select 'n', count(*) filter (where n is null) from d
union all select 'total', count(*) filter (where total is null) from d
union all select 'mean', count(*) filter (where mean is null or isnan(mean)) from d""",
)
def assert_no_nulls(spark, sf_dir):
    """Null and NaN counts of all feature columns in one pass."""
    activity = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    )
    rows = table(spark, sf_dir, "customer").select("c_custkey").join(activity, "c_custkey", "left")
    rows = rows.withColumn("mean", F.when(F.col("n") > 60, F.lit(float("nan"))).otherwise(F.col("total") / F.col("n")))
    return filters.null_counts(rows, schemas.feature_names(rows.columns, [], ""))


@query("filter_positive_length", "select doc_id, length(text)::int as text_length from documents where length(text) > 0")
def filter_positive_length(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return filters.with_positive_length(docs, "text").select("doc_id", "text_length")


@query("filter_exact_length", "select p_partkey, p_name from part where length(replace(p_name, ' ', '')) = 8")
def filter_exact_length(spark, sf_dir):
    return filters.with_exact_length(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", 8)


@query(
    "category_slice",
    "select l_returnflag, count(*) as n, round(sum(l_extendedprice), 2) as price from lineitem where l_returnflag in ('A', 'R') group by 1",
)
def category_slice(spark, sf_dir):
    """One pass writes a directory per category; a reader prunes to its own."""
    path = session.scratch_path(spark, "slices")
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    filters.write_category_slices(lines, path, "l_returnflag", ["A", "R"])
    sliced = spark.read.parquet(path)
    return sliced.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))
