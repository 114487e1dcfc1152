"""Scalar functions over text, JSON, numbers and vectors."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import bindings, query, table
from larder.functions import nested, numbers, text, vectors
from larder.operators import aggregates, merge
from larder.plans import features

_OPTIONAL_BADGES = f"""{bindings.BADGE_SQL},
b as (select account_sid, case account_sid % 3 when 0 then null when 1 then '' else badge_type end as badge_type from badges)"""


def _optional_badges(spark, sf_dir):
    """A third of the users without badges, a third with an empty text."""
    kind = F.col("account_sid") % 3
    value = F.when(kind == 1, "").when(kind == 2, F.col("badge_type"))
    return bindings.user_badges(spark, sf_dir).withColumn("badge_type", value)


@query(
    "split_pipe",
    f"""with {_OPTIONAL_BADGES}
select account_sid, case when badge_type <> '' then len(string_split(badge_type, '|')) end as n,
       case when badge_type <> '' then string_split(badge_type, '|')[1] end as first from b""",
)
def split_pipe(spark, sf_dir):
    rows = _optional_badges(spark, sf_dir).withColumn("parts", text.split_pipe("badge_type"))
    size = F.when(F.col("parts").isNotNull(), F.size("parts")).cast("bigint")
    return rows.select("account_sid", size.alias("n"), F.get("parts", F.lit(0)).alias("first"))


@query(
    "split_badges",
    f"""with {_OPTIONAL_BADGES}
select account_sid, coalesce(case when badge_type <> '' then len(string_split(badge_type, '|')) end, 0) as n from b""",
)
def split_badges(spark, sf_dir):
    rows = _optional_badges(spark, sf_dir)
    return rows.select("account_sid", F.size(text.split_badges("badge_type")).cast("bigint").alias("n"))


_FLAG_SQL = ", ".join(f"coalesce(list_contains(string_split(badge_type, '|'), '{b}'), false)::int as \"{b}\"" for b in bindings.BADGES)


@query("badge_onehot", f"with {_OPTIONAL_BADGES} select account_sid, badge_type, {_FLAG_SQL} from b")
def badge_onehot(spark, sf_dir):
    return features.badge_flags(_optional_badges(spark, sf_dir), "account_sid", "badge_type", bindings.BADGES)


@query(
    "badge_onehot_substring",
    f"""with {_OPTIONAL_BADGES}
select account_sid, badge_type, (coalesce(contains(badge_type, 'chase'), false))::int as chase,
       (coalesce(contains(badge_type, 'sign'), false))::int as sign from b""",
)
def badge_onehot_substring(spark, sf_dir):
    rows = _optional_badges(spark, sf_dir)
    return features.badge_flags(rows, "account_sid", "badge_type", ["chase", "sign"], mode="substring")


@query(
    "earliest_of_two",
    """select user_id, case when v is null then p when p is null or v < p then v else p end::varchar as first_time from
(select user_id, min(ts) filter (where event_type = 'view' and value > 100) as v,
        min(ts) filter (where event_type = 'purchase' and value > 100) as p from events group by 1)""",
)
def earliest_of_two(spark, sf_dir):
    def first(kind):
        return F.min(F.when((F.col("event_type") == kind) & (F.col("value") > 100), F.col("ts")))

    sides = table(spark, sf_dir, "events").groupBy("user_id").agg(first("view").alias("v"), first("purchase").alias("p"))
    return sides.select("user_id", numbers.earliest("v", "p").cast("string").alias("first_time"))


@query(
    "text_length",
    "select doc_id, coalesce(length(case when lang <> 'de' then text end), 0) as n from documents",
)
def text_length(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("t", F.when(F.col("lang") != "de", F.col("text")))
    return docs.select("doc_id", text.text_length("t").cast("bigint").alias("n"))


@query(
    "json_parse_field",
    """select event_id, case when event_id % 5 <> 0 then json_extract_string(props, '$.k')::bigint end as k from events""",
)
def json_parse_field(spark, sf_dir):
    """Every fifth text is broken and parses to null."""
    broken = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("{oops "), "props")).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", nested.parse_json(broken, "k bigint")["k"].alias("k"))


@query(
    "json_parse_array",
    """select user_id, event_type, cast(sum(json_extract_string(props, '$.k')::int) as bigint) as total, count(*) as n
from (select distinct user_id, event_type, props from events) group by all""",
)
def json_parse_array(spark, sf_dir):
    """An array of distinct JSON texts per user and type; ``props`` has 100 values."""
    texts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.collect_set("props").alias("items"))
    parsed = texts.withColumn("items", nested.parse_json_array("items", "struct<k: bigint>"))
    total = F.aggregate("items", F.lit(0).cast("bigint"), lambda s, x: s + x["k"])
    return parsed.select("user_id", "event_type", total.alias("total"), F.size("items").cast("bigint").alias("n"))


@query(
    "json_or_raw",
    """select event_id, case when event_id % 2 = 0 then props else event_type end as field,
       case when event_id % 2 = 0 then json_extract_string(props, '$.k')::int end as k from events""",
)
def json_or_raw(spark, sf_dir):
    mixed = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.col("event_type"))
    rows = nested.json_or_raw(table(spark, sf_dir, "events").select("event_id", mixed.alias("field")), "field")
    return rows.select("event_id", "field", F.variant_get("field_json", "$.k", "int").alias("k"))


@query(
    "to_json_field",
    """select s_suppkey, '{"name":"' || s_name || '"' || case when s_acctbal > 0 then ',"nation":' || s_nationkey else '' end || '}' as doc,
'{"name":"' || s_name || '","nation":' || case when s_acctbal > 0 then s_nationkey::varchar else 'null' end || '}' as whole from supplier""",
)
def to_json_field(spark, sf_dir):
    nation = F.when(F.col("s_acctbal") > 0, F.col("s_nationkey")).alias("nation")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.struct(F.col("s_name").alias("name"), nation).alias("d"))
    return rows.select("s_suppkey", nested.to_json_text("d").alias("doc"), nested.to_json_text("d", keep_nulls=True).alias("whole"))


@query(
    "merge_to_array",
    "select c_custkey, c_name || ',' || c_mktsegment as names, c_nationkey from customer",
)
def merge_to_array(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").drop("c_acctbal")
    merged = nested.merge_to_array(customers, {"names": ["c_name", "c_mktsegment"]})
    return merged.withColumn("names", F.array_join("names", ","))


@query(
    "merge_to_struct",
    """select p_partkey, p_name, '{"p_brand":"' || p_brand || '","p_size":' || p_size || '}' as details, p_type from part""",
)
def merge_to_struct(spark, sf_dir):
    parts = table(spark, sf_dir, "part").drop("p_retailprice")
    merged = nested.merge_to_struct(parts, {"details": ["p_brand", "p_size"]})
    return merged.withColumn("details", F.to_json("details"))


@query(
    "bitmap_to_ranges",
    """with hours as (select distinct user_id, hour(ts) as h from events where value > 60),
runs as (select user_id, h, h - row_number() over (partition by user_id order by h) as run from hours),
ranges as (select user_id, min(h) as a, max(h) + 1 as b from runs group by user_id, run)
select u.user_id, case when u.user_id % 10 <> 0 then
  coalesce(string_agg(lpad(a::varchar, 2, '0') || ':00-' || lpad(b::varchar, 2, '0') || ':00', ' ' order by a), '') end as ranges
from (select distinct user_id from events) u left join ranges r on r.user_id = u.user_id group by u.user_id""",
)
def bitmap_to_ranges(spark, sf_dir):
    """The hours of a user's larger events as a 24-bit text, then as ranges."""
    hour = F.when(F.col("value") > 60, F.hour("ts"))
    seen = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set(hour).alias("hours"))
    slots = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.array_contains("hours", h).cast("int").cast("string"))
    bits = F.when(F.col("user_id") % 10 != 0, F.array_join(slots, ""))
    return seen.select("user_id", F.array_join(text.bit_ranges(bits), " ").alias("ranges"))


@query(
    "tokenize_field",
    """select doc_id, len(t) as n, t[1] as first, t[-1] as last from
(select doc_id, regexp_extract_all(text, '[^ \t\n\r\f\v]+') as t from documents)""",
)
def tokenize_field(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = text.with_tokens(docs, ["text"], lambda c: text.tokens(c, "[^ \t\n\r\f\x0b]+"))
    words = F.col("text_token")
    return rows.select(
        "doc_id",
        F.size(words).cast("bigint").alias("n"),
        F.get(words, F.lit(0)).alias("first"),
        F.get(words, F.size(words) - 1).alias("last"),
    )


@query("condense_space", "select doc_id, md5(regexp_replace(text, '[ \t\n\r\f\v]', '', 'g')) as digest from documents")
def condense_space(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.condense("text")).alias("digest"))


@query(
    "vector_pair_mean",
    """select a.vec_id, (i - 1)::int as pos, round((a.embedding[i]::double + coalesce(b.embedding[i], a.embedding[i])::double) / 2, 6) as value
from embeddings a left join embeddings b on b.vec_id = a.vec_id + 250, range(1, 65) r(i)""",
)
def vector_pair_mean(spark, sf_dir):
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    other = embeddings.select((F.col("vec_id") - 250).alias("vec_id"), F.col("embedding").alias("y"))
    joined = embeddings.join(other, "vec_id", "left")
    means = joined.select("vec_id", F.posexplode(vectors.pair_mean("embedding", "y")).alias("pos", "value"))
    return means.withColumn("value", F.round("value", 6))


@query(
    "vector_dot",
    """select a.vec_id, round(list_inner_product(a.embedding::double[], b.embedding::double[]), 6) as score
from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""",
)
def vector_dot(spark, sf_dir):
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    other = embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("y"))
    return embeddings.join(other, "vec_id").select("vec_id", F.round(vectors.dot("embedding", "y"), 6).alias("score"))


@query(
    "null_normalize",
    "select event_id, case when value <= 80 then value end as value, case when value <= 80 then round(value / 4, 6) end as quarter from events",
)
def null_normalize(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.when(F.col("value") > 80, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    clean = events.withColumn("value", numbers.null_normalize("value"))
    return clean.withColumn("quarter", F.round(F.col("value") / 4, 6))


@query(
    "safe_cast_compare",
    """select event_id, case when event_id % 4 <> 0 then (value / 20 >= 3.0)::int end as positive from events""",
)
def safe_cast_compare(spark, sf_dir):
    """Every fourth score is not a number: neither positive nor negative."""
    score = F.when(F.col("event_id") % 4 == 0, F.lit("n/a")).otherwise((F.col("value") / 20).cast("string"))
    positive = numbers.to_number(score) >= aggregates.POSITIVE_SCORE
    return table(spark, sf_dir, "events").select("event_id", positive.cast("int").alias("positive"))


@F.pandas_udf(T.DoubleType())
def _weighted(quantity: pd.Series, price: pd.Series) -> pd.Series:
    return (price * 0.9).where(quantity > 30, price)


@query(
    "user_transform",
    """select l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 4) as net,
       round(sum(case when l_quantity > 30 then l_extendedprice * 0.9 else l_extendedprice end), 4) as weighted
from lineitem group by 1""",
)
def user_transform(spark, sf_dir):
    """Two user transforms of several fields to one: an expression and a pandas UDF."""
    made = merge.transform_fields(
        table(spark, sf_dir, "lineitem"),
        "l_orderkey",
        {
            "net": (["l_extendedprice", "l_discount"], lambda price, discount: price * (1 - discount)),
            "weighted": (["l_quantity", "l_extendedprice"], _weighted),
        },
    )
    return made.groupBy("l_orderkey").agg(*[F.round(F.sum(c), 4).alias(c) for c in ("net", "weighted")])
