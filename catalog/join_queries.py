"""Equi-joins of keyed documents and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bindings, query, table
from larder import session
from larder.functions import numbers
from larder.functions import vectors as vector_columns
from larder.operators import aggregates, joins, ranking
from larder.plans import features
from larder.sources.keyed import KeyedTable

def _side(spark, sf_dir, kind, first, n):
    rows = table(spark, sf_dir, "events").filter(F.col("event_type") == kind)
    item = F.get_json_object("props", "$.k").cast("int").alias("item")
    return rows.groupBy("user_id", item).agg(F.min("ts").alias(first), F.count("*").alias(n))


@query(
    "join_full_outer",
    """with l as (select user_id, json_extract_string(props, '$.k')::int as item, min(ts) as first_view, count(*) as views
           from events where event_type = 'view' group by all),
r as (select user_id, json_extract_string(props, '$.k')::int as item, min(ts) as first_purchase, count(*) as purchases
      from events where event_type = 'purchase' group by all)
select user_id, item, views, purchases, least(first_view, first_purchase)::varchar as first_seen
from l full outer join r using (user_id, item)""",
)
def join_full_outer(spark, sf_dir):
    views = _side(spark, sf_dir, "view", "first_view", "views")
    purchases = _side(spark, sf_dir, "purchase", "first_purchase", "purchases")
    joined = joins.full_outer_unique(views, purchases, ["user_id", "item"])
    first = numbers.earliest("first_view", "first_purchase").cast("string").alias("first_seen")
    return joined.select("user_id", "item", "views", "purchases", first)


@query(
    "join_full_outer_null_safe",
    """with l as (select case when user_id % 7 <> 0 then user_id end as u, event_type, count(*) as n from events where user_id % 3 <> 0 group by all),
r as (select case when user_id % 7 <> 0 then user_id end as u, event_type, count(*) as m from events where user_id % 3 <> 1 group by all)
select coalesce(l.u, r.u) as u, coalesce(l.event_type, r.event_type) as event_type, n, m
from l full outer join r on l.u is not distinct from r.u and l.event_type = r.event_type""",
)
def join_full_outer_null_safe(spark, sf_dir):
    """Null key parts pair with each other."""
    events = table(spark, sf_dir, "events").withColumn("u", F.when(F.col("user_id") % 7 != 0, F.col("user_id")))
    low = events.filter("user_id % 3 <> 0").groupBy("u", "event_type").agg(F.count("*").alias("n"))
    high = events.filter("user_id % 3 <> 1").groupBy("u", "event_type").agg(F.count("*").alias("m"))
    return joins.full_outer_unique(low, high, ["u", "event_type"], null_safe=True)


@query(
    "join_semi_positive",
    f"""with {bindings.LOG_SQL}
select event_id, recommendation_sid, (event_type = 'purchase')::int as label from log
where recommendation_sid in (select recommendation_sid from log where event_type = 'purchase')""",
)
def join_semi_positive(spark, sf_dir):
    log = bindings.interaction_log(spark, sf_dir)
    rows = log.select("event_id", "recommendation_sid", (F.col("event_type") == "purchase").cast("int").alias("label"))
    return joins.keep_with_positive(rows, "recommendation_sid")


@query(
    "join_left_dims",
    "select event_id, user_id, c_mktsegment, c_acctbal from events left join customer on c_custkey = user_id",
)
def join_left_dims(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "user_id")
    unique = aggregates.one_row_per_key(customers, ["user_id"], ["c_mktsegment", "c_acctbal"])
    return joins.attach(events, unique, "user_id")


@query(
    "join_hot_keys",
    """select l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag, n, price from lineitem
join (select l_returnflag, l_linestatus, count(*) as n, round(sum(l_extendedprice), 2) as price from lineitem group by all) using (l_returnflag, l_linestatus)""",
)
def join_hot_keys(spark, sf_dir):
    """Six keys hold all rows: each is split over tasks before the join."""
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_returnflag", "l_linestatus"]
    stats = lines.groupBy(*keys).agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))
    rows = lines.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", *keys)
    joined = joins.join_salting_hot_keys(rows, stats, keys, ["l_orderkey", "l_partkey", "l_linenumber"])
    return joined.drop("l_linestatus")


@query(
    "join_inner_aggs",
    """select l_partkey as item_sid, p as positive_sum, n as negative_sum
from (select l_partkey, count(*) filter (where l_quantity >= 30) as p from lineitem group by 1)
join (select l_partkey, count(*) filter (where l_quantity < 30) as n from lineitem group by 1) using (l_partkey)""",
)
def join_inner_aggs(spark, sf_dir):
    return aggregates.positive_negative_sums(bindings.item_feedback(spark, sf_dir), "item_sid", "interaction")


@query(
    "join_left_mean_fill",
    """with r as (select user_id, (count(*) filter (where value >= 50))::double / count(*) as ratio from events group by 1)
select c_custkey, round(coalesce(ratio, (select avg(ratio) from r)), 8) as ratio from customer left join r on user_id = c_custkey""",
)
def join_left_mean_fill(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    ratio = events.groupBy(F.col("user_id").alias("c_custkey")).agg((F.count_if(F.col("value") >= 50) / F.count("*")).alias("ratio"))
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return joins.fill_with_mean(customers, ratio, "c_custkey", "ratio").withColumn("ratio", F.round("ratio", 8))


@query(
    "join_left_zero_fill",
    """select doc_id, coalesce(quality, 0) as quality, coalesce(toxic, 0) as toxic from documents left join labels using (doc_id)""",
)
def join_left_zero_fill(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return joins.fill_with_zero(docs, table(spark, sf_dir, "labels"), "doc_id", ["quality", "toxic"])


@query(
    "join_left_plain",
    """select c_custkey, click, error from customer left join (select user_id, max((event_type = 'click')::int) as click,
  max((event_type = 'error')::int) as error from events where event_id % 50 <> user_id % 50 or event_type <> 'click' group by 1) on user_id = c_custkey""",
)
def join_left_plain(spark, sf_dir):
    kinds = table(spark, sf_dir, "events").filter("event_id % 50 <> user_id % 50 or event_type <> 'click'").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.array_join(F.collect_set("event_type"), "|").alias("badges")
    )
    flags = features.badge_flags(kinds, "c_custkey", "badges", ["click", "error"]).drop("badges")
    return joins.attach(table(spark, sf_dir, "customer").select("c_custkey"), flags, "c_custkey")


@query(
    "merge_documents_empty_first",
    """select c_custkey, c_nationkey, c_name, n_name, round(c_acctbal, 2) as c_acctbal, n_orders, null::bigint as n_none
from customer join nation on n_nationkey = c_nationkey
left join (select o_custkey, count(*) as n_orders from orders group by 1) on o_custkey = c_custkey where c_acctbal > 0""",
)
def merge_documents_empty_first(spark, sf_dir):
    """Two id sets, related by the second document set, as the first is empty."""
    customers = table(spark, sf_dir, "customer")
    ids = {
        "c_custkey": customers.select("c_custkey", "c_name"),
        "c_nationkey": table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"),
    }
    keys = ["c_custkey", "c_nationkey"]
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    none = customers.filter("c_custkey < 0").select(*keys, F.lit(1).cast("bigint").alias("n_none"))
    rich = customers.filter("c_acctbal > 0").select(*keys, F.round("c_acctbal", 2).alias("c_acctbal"))
    counts = customers.join(orders, "c_custkey").select(*keys, "n_orders")
    return joins.merge_documents(ids, [none, rich, counts])


@query(
    "merge_documents",
    """select c_custkey, n_orders, round(spent, 2) as spent, n_events, last_seen::varchar as last_seen from customer
left join (select o_custkey, count(*) as n_orders, sum(o_totalprice) as spent from orders group by 1) on o_custkey = c_custkey
left join (select user_id, count(*) as n_events, max(ts) as last_seen from events group by 1) on user_id = c_custkey""",
)
def merge_documents(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("spent")
    )
    events = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count("*").alias("n_events"), F.max("ts").cast("string").alias("last_seen")
    )
    ids = {"c_custkey": table(spark, sf_dir, "customer").select("c_custkey")}
    return joins.merge_documents(ids, [orders, events]).withColumn("spent", F.round("spent", 2))


@query(
    "idset_inner_chain",
    """select o_orderkey, o_custkey, c_mktsegment, o_totalprice from orders join customer on c_custkey = o_custkey
where c_acctbal > 0 and o_orderkey in (select l_orderkey from lineitem where l_discount > 0.08)""",
)
def idset_inner_chain(spark, sf_dir):
    """A bare id set (semi join) and one that brings a column (inner join)."""
    customers = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    customers = customers.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    lines = table(spark, sf_dir, "lineitem").filter("l_discount > 0.08").select(F.col("l_orderkey").alias("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.restrict_to_id_sets(orders, {"o_orderkey": lines, "o_custkey": customers})


@query(
    "join_general_features",
    f"""with {bindings.LOG_SQL}, f as (select user_account_sid, item_sid, max(value) as best from log group by all)
select event_id, user_account_sid, item_sid, best from log left join f using (user_account_sid, item_sid)""",
)
def join_general_features(spark, sf_dir):
    """Features repeated per log row are reduced to one row per (user, item)."""
    log = bindings.interaction_log(spark, sf_dir)
    keys = ["user_account_sid", "item_sid"]
    return joins.attach_general(log.select("event_id", *keys), log.withColumnRenamed("value", "best"), keys, ["best"])


@query(
    "lookup_by_keys",
    """select d.doc_id, e.label, round(list_inner_product(e.embedding::double[], e.embedding::double[]), 5) as norm, s.members,
       round(s.first, 5) as first
from documents d left join embeddings e on e.vec_id = d.doc_id
left join (select label, count(*) as members, avg(embedding[1]::double) as first from embeddings group by 1) s on s.label = d.doc_id % 12""",
)
def lookup_by_keys(spark, sf_dir):
    """A vector by id, and a mean vector with its count by category.

    The vectors are a keyed table: those of a batch of ids are read from their directories alone.
    """
    embeddings = table(spark, sf_dir, "embeddings")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 12).cast("int").alias("category"))
    means = aggregates.vector_mean(embeddings, ["label"], "embedding").join(
        embeddings.groupBy("label").agg(F.count("*").alias("members")), "label"
    )
    keyed = KeyedTable(spark, session.scratch_path(spark, "vectors"), ["vec_id"]).write(embeddings, buckets=64)
    wanted = keyed.load(docs.select(F.col("doc_id").alias("vec_id")))
    by_id = joins.lookup(docs, wanted, {"doc_id": "vec_id"}, {"label": "label", "embedding": "adhoc"})
    both = joins.lookup(by_id, means, {"category": "label"}, {"vector": "mean", "members": "members"})
    norm = F.round(vector_columns.dot("adhoc", "adhoc"), 5).alias("norm")
    return both.select("doc_id", "label", norm, "members", F.round(F.col("mean")[0], 5).alias("first"))


@query(
    "lookup_several_keys",
    """select l.vec_id, l.label, r.n, round(r.total, 5) as total from embeddings l left join
(select vec_id, label, count(*) as n, sum(embedding[1]::double) as total from embeddings where label < 7 group by all) r
on r.vec_id = l.vec_id and r.label = l.label""",
)
def lookup_several_keys(spark, sf_dir):
    """A lookup on id and category together."""
    embeddings = table(spark, sf_dir, "embeddings")
    store = embeddings.filter("label < 7").groupBy("vec_id", "label").agg(
        F.count("*").alias("n"), F.sum(F.col("embedding")[0].cast("double")).alias("total")
    )
    rows = embeddings.select("vec_id", "label")
    found = joins.lookup(rows, store, {"vec_id": "vec_id", "label": "label"}, {"n": "n", "total": "total"})
    return found.withColumn("total", F.round("total", 5))


@query(
    "match_condition_fields",
    """with cur as (select user_id, event_type, count(*) as n from events where user_id % 4 <> 0 or ts < timestamp '2024-01-16' group by all),
d as (select user_id, event_type, count(*) as m, round(sum(value), 2) as v from events where user_id % 4 <> 1 or ts >= timestamp '2024-01-16' group by all)
select user_id, event_type, n, m as delta_n, v as delta_v,
       case when n is null then 'delta' when m is null then 'current' else 'both' end as matched
from cur full outer join d using (user_id, event_type)""",
)
def match_condition_fields(spark, sf_dir):
    events, keys = table(spark, sf_dir, "events"), ["user_id", "event_type"]
    current = events.filter("user_id % 4 <> 0 or ts < '2024-01-16'").groupBy(*keys).agg(F.count("*").alias("n"))
    delta = events.filter("user_id % 4 <> 1 or ts >= '2024-01-16'").groupBy(*keys).agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("v")
    )
    return joins.match_on_conditions(current, delta, keys)


@query(
    "join_vectors_left",
    """select l.vec_id, l.label, i::int as pos, round((l.embedding[i]::double + coalesce(h.v[i], l.embedding[i]::double)) / 2, 5) as value
from embeddings l left join (select vec_id, embedding::double[] as v from embeddings where label < 5) h on h.vec_id = l.vec_id,
     range(1, 65) r(i)""",
)
def join_vectors_left(spark, sf_dir):
    embeddings = table(spark, sf_dir, "embeddings")
    history = embeddings.filter("label < 5").select("vec_id", F.col("embedding").alias("past"))
    joined = joins.attach(embeddings, history, "vec_id")
    merged = joined.select("vec_id", "label", F.posexplode(vector_columns.pair_mean("embedding", "past")).alias("pos", "value"))
    return merged.withColumns({"pos": F.col("pos") + 1, "value": F.round("value", 5)})


@query(
    "join_tags_left",
    """select l_suppkey, s_name, p_type, count(*) as n from lineitem join part on p_partkey = l_partkey
left join supplier on s_suppkey = l_suppkey and s_acctbal > 1000 group by all""",
)
def join_tags_left(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    accounts = table(spark, sf_dir, "supplier").filter("s_acctbal > 1000").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    tags = joins.attach(lines.join(parts, "l_partkey"), accounts, "l_suppkey")
    return tags.groupBy("l_suppkey", "s_name", "p_type").agg(F.count("*").alias("n"))


@query(
    "join_topk_back",
    """with f as (select user_id, round(sum(value), 2) as score from events group by 1 order by score desc, user_id limit 10)
select user_id, score, count(*) as n from f join events using (user_id) group by all""",
)
def join_topk_back(spark, sf_dir):
    """Records of the ten best: score and record values from one aggregation."""
    scored = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.round(F.sum("value"), 2).alias("score"), F.count("*").alias("n")
    )
    return ranking.top_k(scored, "score", 10, ["user_id"])

