"""Aggregations, ranking, keyword statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bindings, query, table
from catalog.job_queries import _TERMS_SQL
from larder import session
from larder.functions import text
from larder.operators import aggregates, filters, keywords, merge, ranking
from larder.plans import terms


@query(
    "agg_first_seen",
    f"""with {bindings.LOG_SQL}
select recommendation_sid, user_account_sid, item_sid, min(logged_at)::varchar as logged_at
from log where {bindings.REQUEST} group by all""",
)
def agg_first_seen(spark, sf_dir):
    log = filters.where(bindings.interaction_log(spark, sf_dir), bindings.REQUEST)
    seen = aggregates.first_seen(log, ["recommendation_sid", "user_account_sid", "item_sid"], "logged_at")
    return seen.withColumn("logged_at", F.col("logged_at").cast("string"))


@query(
    "dedupe_by_key",
    """select user_id, event_id, event_type, value from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)
def dedupe_by_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return aggregates.latest_per_key(events, ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value"])


@query(
    "positive_ratio",
    """select l_partkey as item_sid, count(*) filter (where l_quantity >= 30) as positive_sum,
       count(*) filter (where l_quantity < 30) as negative_sum,
       round((count(*) filter (where l_quantity >= 30)) / nullif(count(*), 0)::double, 8) as positive_ratio
from lineitem group by 1""",
)
def positive_ratio(spark, sf_dir):
    made = aggregates.positive_ratio(bindings.item_feedback(spark, sf_dir), "item_sid", "interaction")
    return made.withColumn("positive_ratio", F.round("positive_ratio", 8))


@query("agg_global_mean", "select round(avg(l_extendedprice), 4) as mean from lineitem")
def agg_global_mean(spark, sf_dir):
    return aggregates.global_mean(table(spark, sf_dir, "lineitem"), "l_extendedprice").withColumn("mean", F.round("mean", 4))


@query(
    "collect_sorted_string",
    """select s_suppkey, coalesce(string_agg(p_name, ' ' order by p_name), '') as tag_names
from supplier left join lineitem on l_suppkey = s_suppkey and s_suppkey % 5 <> 0 left join part on p_partkey = l_partkey group by 1""",
)
def collect_sorted_string(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").filter("l_suppkey % 5 <> 0").select("l_partkey", F.col("l_suppkey").alias("s_suppkey"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    tags = table(spark, sf_dir, "supplier").select("s_suppkey").join(lines.join(parts, "l_partkey"), "s_suppkey", "left")
    return aggregates.sorted_tag_text(tags, "s_suppkey", "p_name")


@query(
    "collect_tag_chunks",
    """with placed as (select l_suppkey, p_name, row_number() over (partition by l_suppkey order by p_name) - 1 as place
  from lineitem join part on p_partkey = l_partkey)
select l_suppkey, place // 100 as chunk, string_agg(p_name, ' ' order by p_name) as tag_names from placed group by all""",
)
def collect_tag_chunks(spark, sf_dir):
    """The same in rows of a hundred tags, for suppliers with any number of them."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").join(parts, "l_partkey")
    return aggregates.sorted_tag_chunks(lines, "l_suppkey", "p_name", 100)


def _bounds(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return keywords.boundary_terms(parts, "p_name", keywords.pair_terms(keywords.frequency_tables(parts, "p_name")))


def _stats_sql(term: str) -> str:
    return f"""select len::int as length, round(avg({term}), 8) as term_avg, round(stddev_samp({term}), 8) as term_stddev,
       round(min({term}) filter (where {term} < 0), 8) as term_min,
       round(max({term}) filter (where {term} < 0), 8) as term_max"""


@query(
    "length_group_stats",
    f"""with {_TERMS_SQL}
select 'first' as side, * from ({_stats_sql('first_term')} from bounds group by len)
union all select 'last', * from ({_stats_sql('last_term')} from bounds group by len)""",
)
def length_group_stats(spark, sf_dir):
    bounds = _bounds(spark, sf_dir)
    sides = [
        keywords.length_stats(bounds, f"{side}_term").withColumn("side", F.lit(side)) for side in ("first", "last")
    ]
    both = sides[0].unionByName(sides[1])
    return both.withColumns({c: F.round(c, 8) for c in ("term_avg", "term_stddev", "term_min", "term_max")})


@query("max_condensed_length", "select max(length(regexp_replace(text, '\\s', '', 'g')))::int as max_length from documents")
def max_condensed_length(spark, sf_dir):
    return aggregates.max_condensed_length(table(spark, sf_dir, "documents"), "text")


@query("distinct_categories", "select distinct event_type as badge from events")
def distinct_categories(spark, sf_dir):
    return aggregates.distinct_categories(bindings.user_badges(spark, sf_dir), "badge_type")


@query(
    "category_counts",
    """with c as (select lang, count(*) as n from documents group by 1)
select lang, n, (select avg(n) from c) as mean_n from c""",
)
def category_counts(spark, sf_dir):
    return aggregates.category_counts(table(spark, sf_dir, "documents"), "lang")


@query(
    "token_counts",
    f"""with {_TERMS_SQL}
select 'token2count' as source, token as piece, n as "count", null::bigint as number from token2count
union all select 'cooccur2count', cooccur, n, null from cooccur2count
union all select 'count2token_num', null, n, count(*) from token2count group by n
union all select 'count2cooccur_num', null, n, count(*) from cooccur2count group by n
union all select 'token_count_sum', null, null, cast(sum(n) as bigint) from token2count""",
)
def token_counts(spark, sf_dir):
    """All five frequency tables of the part names."""
    made = keywords.frequency_tables(table(spark, sf_dir, "part"), "p_name")
    none_text, none_number = F.lit(None).cast("string"), F.lit(None).cast("bigint")

    def rows(source, df, piece=none_text, count=none_number, number=none_number):
        return df.select(F.lit(source).alias("source"), piece.alias("piece"), count.alias("count"), number.alias("number"))

    n = F.col("count")
    parts = [
        rows("token2count", made.token2count, F.col("token"), n),
        rows("cooccur2count", made.cooccur2count, F.col("cooccur"), n),
        rows("count2token_num", made.count2token_num, count=n, number=F.col("n_token")),
        rows("count2cooccur_num", made.count2cooccur_num, count=n, number=F.col("n_occur")),
        rows("token_count_sum", made.token_count_sum, number=F.col("token_count_sum")),
    ]
    result = parts[0]
    for more in parts[1:]:
        result = result.unionByName(more)
    return result


_METRICS_SQL = """with c as (select source,
    count(*) filter (where quality = 1 and n_chars > 300) as true_positive,
    count(*) filter (where quality <> 1 and n_chars > 300) as false_positive,
    count(*) filter (where quality = 1 and n_chars <= 300) as false_negative,
    count(*) filter (where n_chars > 300) as predicted_positive, count(*) as n
  from documents join labels using (doc_id) group by 1)
select *, round(true_positive / nullif(true_positive + false_positive, 0)::double, 8) as precision,
       round(true_positive / nullif(true_positive + false_negative, 0)::double, 8) as recall,
       round(2.0 * true_positive / nullif(2.0 * true_positive + false_positive + false_negative, 0)
             + case when true_positive = 0 then null else 0 end, 8) as f1 from c"""


@query("classification_metrics", _METRICS_SQL)
def classification_metrics(spark, sf_dir):
    """A length rule judged against the quality labels, per source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", (F.col("n_chars") > 300).cast("int").alias("guess"))
    judged = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    made = aggregates.classification_metrics(judged, "quality", "guess", ["source"])
    return made.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


@query(
    "vector_mean_by_key",
    """select label, pos::int as pos, round(avg(x::double), 6) as value from
(select label, unnest(embedding) as x, unnest(range(64)) as pos from embeddings) group by all""",
)
def vector_mean_by_key(spark, sf_dir):
    means = aggregates.vector_mean(table(spark, sf_dir, "embeddings"), ["label"], "embedding")
    return means.select("label", F.posexplode("vector").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query(
    "row_counts",
    """select 'all' as stage, count(*) as rows from events
union all select 'requests', count(*) from events where event_type in ('view', 'click')
union all select 'large requests', count(*) from events where event_type in ('view', 'click') and value > 100""",
)
def row_counts(spark, sf_dir):
    """Rows per stage, counted while one write runs through all stages."""
    watched, all_rows = aggregates.observe_count(table(spark, sf_dir, "events"), "all")
    watched, requests = aggregates.observe_count(watched.filter(bindings.REQUEST), "requests")
    watched, large = aggregates.observe_count(watched.filter("value > 100"), "large requests")
    watched.select("event_id").write.parquet(session.scratch_path(spark, "row-counts"))
    counted = [("all", all_rows), ("requests", requests), ("large requests", large)]
    return spark.createDataFrame([(name, watch.get["rows"]) for name, watch in counted], "stage string, rows bigint")


@query(
    "stage_counts",
    """select 'orders' as stage, count(*) as rows from orders
union all select 'open', count(*) from orders where o_orderstatus = 'O'""",
)
def stage_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return aggregates.stage_counts({"orders": orders, "open": orders.filter("o_orderstatus = 'O'")})


@query(
    "changed_count",
    """select count(distinct user_id) as changed from events
where ts >= timestamp '2024-01-30 18:00:00' - interval 7200 second and ts < timestamp '2024-01-30 18:00:00'""",
)
def changed_count(spark, sf_dir):
    end = F.lit("2024-01-30 18:00:00").cast("timestamp_ntz")
    return aggregates.changed_count(table(spark, sf_dir, "events"), "user_id", merge.in_window("ts", end, 7200))


@query("topk_by_score", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def topk_by_score(spark, sf_dir):
    return ranking.top_k(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 25, ["o_orderkey"])


@query("sort_distinct", "select distinct p_name from part order by 1")
def sort_distinct(spark, sf_dir):
    return ranking.sorted_distinct(table(spark, sf_dir, "part"), "p_name")


@query("next_record_id", "select max(o_orderkey) + 1 as next_id from orders")
def next_record_id(spark, sf_dir):
    return ranking.next_id(table(spark, sf_dir, "orders"), "o_orderkey")


@query(
    "assign_vector_ids",
    f"""select event_id, event_type, row_number() over (partition by event_type
  order by {bindings.sql_hash(42, 'event_id')}, event_id) - 1 as vid from events""",
)
def assign_vector_ids(spark, sf_dir):
    """Sequential ids per category, numbered by many tasks."""
    return ranking.dense_ids(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id", ["event_type"])


_KEYWORD_TERMS = f"""with {_TERMS_SQL},
pos as (select keyword, w, unnest(range(1, length(w))) as i from (select distinct keyword, w from words)),
found as (select keyword, i, term from pos join terms on cooccur = substr(w, i::int, 2))"""


@query(
    "conditional_entropy_terms",
    _KEYWORD_TERMS + " select keyword, round(-sum(term), 8) as entropy, count(*) as n from found group by 1",
)
def conditional_entropy_terms(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    made = keywords.keyword_terms(parts, "p_name", keywords.pair_terms(keywords.frequency_tables(parts, "p_name")))
    return made.select("keyword", F.round("entropy", 8).alias("entropy"), F.size("terms").cast("bigint").alias("n"))


@query(
    "first_last_term",
    _KEYWORD_TERMS
    + """ select keyword, round(max(term) filter (where i = 1), 10) as first_term,
  round(max(term) filter (where i = n), 10) as last_term
from found join (select keyword, max(i) as n from found group by 1) using (keyword) group by 1""",
)
def first_last_term(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    made = keywords.keyword_terms(parts, "p_name", keywords.pair_terms(keywords.frequency_tables(parts, "p_name")))
    ends = keywords.first_and_last_term(made).select("keyword", "first_term", "last_term")
    return ends.withColumns({c: F.round(c, 10) for c in ("first_term", "last_term")})


@query(
    "linspace_threshold",
    f"""with {_TERMS_SQL} select len::int as length, round(ft, 10) as threshold from limits""",
)
def linspace_threshold(spark, sf_dir):
    return terms.thresholds(_bounds(spark, sf_dir), "first_term").select("length", F.round("threshold", 10).alias("threshold"))


@query(
    "document_vocabulary",
    """with words as (select distinct unnest(regexp_extract_all(text, '[^ \t\n\r\f\v]+')) as keyword from documents),
c as (select keyword from words)
select length(keyword)::int as length, count(*) as n from c group by 1""",
)
def document_vocabulary(spark, sf_dir):
    """Distinct words of all documents by length: the keywords of a corpus."""
    words = table(spark, sf_dir, "documents").select(F.explode(text.tokens("text", "[^ \t\n\r\f\x0b]+")).alias("keyword")).distinct()
    return words.groupBy(F.length("keyword").alias("length")).agg(F.count("*").alias("n"))
