"""How the given tables stand in for the inputs of the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import table
from larder.plans.labels import LabelSpec

REQUEST = "event_type in ('view', 'click')"
RESPONSE = "event_type = 'purchase'"


def sql_hash(seed: int, *columns: str) -> str:
    """DuckDB text of the 60-bit hash of a key."""
    key = " || '|' || ".join(f"({c})::varchar" for c in columns)
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 15))::bigint"


def sql_sample(seed: int, fraction: float, *columns: str) -> str:
    """DuckDB text of the condition that a key is in a sample."""
    return f"({sql_hash(seed, *columns)} < {int(fraction * 2**60)})"


def interaction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's day is a recommendation, ``props.k`` the item."""
    day = F.to_date("ts").cast("string")
    return table(spark, sf_dir, "events").select(
        F.concat_ws("|", F.col("user_id").cast("string"), day).alias("recommendation_sid"),
        F.col("user_id").alias("user_account_sid"),
        F.get_json_object("props", "$.k").cast("int").alias("item_sid"),
        F.col("ts").alias("logged_at"),
        "event_type",
        "event_id",
        "value",
    )


LOG_SQL = """log as (
  select user_id::varchar || '|' || strftime(ts, '%Y-%m-%d') as recommendation_sid,
         user_id as user_account_sid,
         json_extract_string(props, '$.k')::int as item_sid,
         ts as logged_at, event_type, event_id, value
  from events)"""


def label_spec(fraction: float, attributes: tuple[str, ...] = ("event_type", "value")) -> LabelSpec:
    return LabelSpec(REQUEST, RESPONSE, user_attributes=attributes, negative_fraction=fraction)


def labeled_sql(fraction: float) -> str:
    """Labelled dataset as CTEs: both sides aggregated, then a full outer join."""
    sampled = sql_sample(42, fraction, "recommendation_sid", "user_account_sid", "item_sid")
    return f"""{LOG_SQL},
asked as (select recommendation_sid, user_account_sid, item_sid, min(logged_at) as l
          from log where {REQUEST} group by all),
answered as (select recommendation_sid, user_account_sid, item_sid, min(logged_at) as r
             from log where {RESPONSE} group by all),
paired as (select recommendation_sid, user_account_sid, item_sid, l, r
           from asked full outer join answered using (recommendation_sid, user_account_sid, item_sid)),
kept as (select *, 1 as label from paired where r is not null
         union all
         select *, 0 as label from paired where r is null and {sampled}),
attributes as (select user_account_sid, event_type, value from log
               qualify row_number() over (partition by user_account_sid
                                          order by logged_at desc, event_type desc, value desc) = 1),
labeled as (select recommendation_sid, user_account_sid, item_sid,
                   case when l is null then r when r is null or l < r then l else r end as logged_at,
                   label, event_type, value
            from kept left join attributes using (user_account_sid)
            where recommendation_sid in (select recommendation_sid from kept where label = 1))"""


def item_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores per item as text: a tenth of the quantity of a line item."""
    score = (F.col("l_quantity") / 10).cast("string")
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("item_sid"), score.alias("interaction"))


RATIO_SQL = """ratio as (
  select l_partkey as item_sid,
         (count(*) filter (where l_quantity >= 30))::double / count(*) as positive_ratio
  from lineitem group by 1)"""


def user_badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct event types per user, joined by a pipe; five types exist."""
    kinds = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("b"))
    return kinds.select(F.col("user_id").alias("account_sid"), F.array_join("b", "|").alias("badge_type"))


BADGE_SQL = """badges as (
  select user_id as account_sid, string_agg(distinct event_type, '|' order by event_type) as badge_type
  from events group by 1)"""

BADGES = ("click", "error", "purchase", "signup", "view")


def item_introductions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("account_sid"), F.col("text").alias("item_introduction")
    )
