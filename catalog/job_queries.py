"""The composite jobs: labelling, windows, marts, features, thresholds, publishing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog import bindings, query, table
from larder import session
from larder.operators import aggregates, keywords, sampling
from larder.plans import documents, features, labels, mart, terms
from larder.plans.windows import ORDINAL, PeriodWindows, pit_join, window_features
from larder.sources import snapshots
from larder.sources.serving import ServingTable


def _text_time(df, *columns):
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


_LABELED = """with {ctes}
select recommendation_sid, user_account_sid, item_sid, logged_at::varchar as logged_at, label, event_type, value
from labeled"""


@query("labeled_interactions", _LABELED.format(ctes=bindings.labeled_sql(1.0)))
def labeled_interactions(spark, sf_dir):
    log = bindings.interaction_log(spark, sf_dir)
    return _text_time(labels.labeled_interactions(log, bindings.label_spec(1.0)), "logged_at")


@query("labeled_interactions_sampled", _LABELED.format(ctes=bindings.labeled_sql(0.1)))
def labeled_interactions_sampled(spark, sf_dir):
    log = bindings.interaction_log(spark, sf_dir)
    return _text_time(labels.labeled_interactions(log, bindings.label_spec(0.1)), "logged_at")


START, SPLIT, END = datetime(2024, 1, 8), datetime(2024, 1, 22), datetime(2024, 1, 31)

_WINDOWS_SQL = """win as (
  select i::int as window_no, s + to_days((i * {period})::int) as w_start,
         least(s + to_days(((i + 1) * {period})::int), e) as w_end,
         s + to_days((i * {period} - {period} - {gap})::int) as p_start, s + to_days((i * {period} - {gap})::int) as p_end, phase
  from (values {bounds}) b(phase, s, e), range(0, 20) r(i)
  where s + to_days((i * {period})::int) < e)"""


def _windows_sql(period, gap, *bounds):
    values = ", ".join(f"('{n}', timestamp '{s}', timestamp '{e}')" for n, s, e in bounds)
    return _WINDOWS_SQL.format(period=period, gap=gap, bounds=values)


@query(
    "period_windows",
    f"""with {_windows_sql(7, 1, ("all", START, END))}
select window_no, p_start::varchar as prev_start, p_end::varchar as prev_end, w_start::varchar as "start",
       w_end::varchar as "end",
       (select count(*) from events where ts >= w_start and ts < w_end) as target_rows,
       (select count(*) from events where ts >= p_start and ts < p_end) as source_rows
from win""",
)
def period_windows(spark, sf_dir):
    windows = PeriodWindows(START, END, 7, gap_days=1)
    events = table(spark, sf_dir, "events")
    targets = windows.targets(events, "ts").groupBy(ORDINAL).agg(F.count("*").alias("target_rows"))
    sources = windows.sources(events, "ts").groupBy(ORDINAL).agg(F.count("*").alias("source_rows"))
    frame = windows.frame(spark).join(targets, ORDINAL, "left").join(sources, ORDINAL, "left")
    return _text_time(frame.fillna(0), "prev_start", "prev_end", "start", "end")


def _activity():
    return {"prev_events": F.count("value"), "prev_value": F.avg("value")}


@query(
    "pit_join",
    f"""with {_windows_sql(7, 0, ("all", START, END))}
select e.event_id, w.window_no, nullif(count(p.event_id), 0) as prev_events, round(avg(p.value), 6) as prev_value
from events e
join win w on e.ts >= w.w_start and e.ts < w.w_end
left join events p on p.user_id = e.user_id and p.ts >= w.p_start and p.ts < w.p_end
group by all""",
)
def pit(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    made = [c.alias(n) for n, c in _activity().items()]
    joined = pit_join(events, events, PeriodWindows(START, END, 7), ["user_id"], "ts", "ts", made, ["event_id"])
    return joined.select("event_id", ORDINAL, "prev_events", F.round("prev_value", 6).alias("prev_value"))


@query(
    "offline_features",
    f"""with {_windows_sql(3, 1, ("all", START, END))}
select user_id, window_no, count(*) as prev_events, round(avg(value), 6) as prev_value
from win join events on ts >= p_start and ts < p_end group by all""",
)
def offline_features(spark, sf_dir):
    made = [c.alias(n) for n, c in _activity().items()]
    rows = window_features(table(spark, sf_dir, "events"), PeriodWindows(START, END, 3, 1), ["user_id"], "ts", made)
    return rows.withColumn("prev_value", F.round("prev_value", 6))


MART_SPEC = mart.MartSpec(
    keys=["recommendation_sid", "user_account_sid", "item_sid"],
    sample_keys=["recommendation_sid", "user_account_sid", "item_sid"],
    extras=["event_type", "value"],
    periodic=["user_activity"],
    general=["positive_ratio", "intro_len", "user_badges"],
)
PHASES = (mart.Phase("training", START, SPLIT), mart.Phase("test", SPLIT, END, mart.TEST_FRACTION))


def mart_registry(spark, sf_dir) -> features.FeatureRegistry:
    """The features of the mart, each over its whole table."""
    ratio = aggregates.positive_ratio(bindings.item_feedback(spark, sf_dir), "item_sid", "interaction")
    ratio = session.materialise(ratio, "ratio")
    mean = ratio.agg(F.avg("positive_ratio").alias("mean")).first()["mean"]
    lengths = features.text_length_table(
        bindings.item_introductions(spark, sf_dir).withColumnRenamed("account_sid", "item_sid"),
        "item_sid",
        "item_introduction",
    )
    badges = bindings.user_badges(spark, sf_dir).withColumnRenamed("account_sid", "user_account_sid")
    flags = features.badge_flags(badges, "user_account_sid", "badge_type", bindings.BADGES)
    activity = features.windowed_feature(
        "user_activity",
        bindings.interaction_log(spark, sf_dir),
        ["user_account_sid"],
        "logged_at",
        _activity(),
        ["recommendation_sid", "item_sid"],
    )
    return (
        features.FeatureRegistry()
        .register(activity)
        .register(features.positive_ratio_feature(ratio, "item_sid", mean=mean))
        .register(features.text_length_feature(lengths, "item_sid"))
        .register(features.badge_feature(flags, "user_account_sid", bindings.BADGES, "user_badges"))
    )


def _mart(spark, sf_dir, labeled):
    return mart.mart_dataset(labeled, mart_registry(spark, sf_dir), MART_SPEC, PHASES)


_MART_SAMPLE = bindings.sql_sample(7, mart.TEST_FRACTION, "recommendation_sid", "user_account_sid", "item_sid")
_FLAGS = ", ".join(f"max((event_type = '{b}')::int) as \"{b}\"" for b in bindings.BADGES)
_MART_SQL = f"""with {bindings.labeled_sql(0.5)},
{_windows_sql(7, 0, ("training", START, SPLIT), ("test", SPLIT, END))},
{bindings.RATIO_SQL},
rows_in as (select l.*, w.phase, w.p_start, w.p_end from labeled l join win w
            on logged_at >= w_start and logged_at < w_end
            where phase = 'training' or {_MART_SAMPLE}),
activity as (select r.recommendation_sid, r.user_account_sid, r.item_sid,
                    nullif(count(e.event_id), 0) as prev_events, avg(e.value) as prev_value
             from rows_in r left join events e
               on e.user_id = r.user_account_sid and e.ts >= r.p_start and e.ts < r.p_end group by all),
flags as (select user_id as user_account_sid, {_FLAGS} from events group by 1)
select r.recommendation_sid, r.user_account_sid, r.item_sid, r.logged_at::varchar as logged_at, r.label, r.phase,
       a.prev_events, round(a.prev_value, 6) as prev_value,
       round(coalesce(q.positive_ratio, (select avg(positive_ratio) from ratio)), 6) as positive_ratio,
       coalesce(d.n, 0)::int as intro_len,
       f.click, f.error, f.purchase, f.signup, f."view"
from rows_in r
join activity a using (recommendation_sid, user_account_sid, item_sid)
left join ratio q using (item_sid)
left join (select doc_id, length(text) as n from documents where length(text) > 0) d on d.doc_id = r.item_sid
left join flags f using (user_account_sid)"""


@query("mart_dataset", _MART_SQL)
def mart_dataset(spark, sf_dir):
    log = bindings.interaction_log(spark, sf_dir)
    labeled = session.materialise(labels.labeled_interactions(log, bindings.label_spec(0.5)), "labeled")
    rows = _mart(spark, sf_dir, labeled)
    rounded = {c: F.round(c, 6) for c in ("prev_value", "positive_ratio")}
    return _text_time(rows.withColumns(rounded), "logged_at")


@query(
    "mart_snapshots",
    f"""select phase, count(*) as n, cast(sum(label) as bigint) as positives, cast(sum(prev_events) as bigint) as events,
       cast(sum(intro_len) as bigint) as characters
from ({_MART_SQL}) group by phase""",
)
def mart_snapshots(spark, sf_dir):
    """Land the labelled dataset, build and write both phases, read them back."""
    root = session.scratch_path(spark, "mart")
    log = bindings.interaction_log(spark, sf_dir)
    snapshots.write_parquet(labels.labeled_interactions(log, bindings.label_spec(0.5)), f"{root}/lake")
    labeled = snapshots.read_parquet(spark, f"{root}/lake")
    mart.write_mart(_mart(spark, sf_dir, labeled), f"{root}/mart")
    phases = [mart.read_mart(spark, f"{root}/mart", p.name).withColumn("phase", F.lit(p.name)) for p in PHASES]
    return sampling.union_all(*phases).groupBy("phase").agg(
        F.count("*").alias("n"),
        F.sum("label").alias("positives"),
        F.sum("prev_events").alias("events"),
        F.sum("intro_len").cast("bigint").alias("characters"),
    )


@query(
    "feature_registry",
    f"""with {bindings.RATIO_SQL}, {bindings.LOG_SQL}
select log.event_id, round(coalesce(positive_ratio, (select avg(positive_ratio) from ratio)), 6) as positive_ratio,
       coalesce(n, 0)::int as intro_len
from log left join ratio using (item_sid)
left join (select doc_id, length(text) as n from documents where length(text) > 0) d on d.doc_id = log.item_sid""",
)
def feature_registry(spark, sf_dir):
    """Two features looked up by name and applied in order."""
    log = bindings.interaction_log(spark, sf_dir)
    rows, added = mart_registry(spark, sf_dir).apply_general(log, ["positive_ratio", "intro_len"])
    return rows.select("event_id", *added).withColumn("positive_ratio", F.round("positive_ratio", 6))


@query(
    "feature_positive_ratio",
    f"""with {bindings.RATIO_SQL}
select p_partkey as item_sid, round(coalesce(positive_ratio, (select avg(positive_ratio) from ratio)), 6) as positive_ratio
from part left join ratio on item_sid = p_partkey""",
)
def feature_positive_ratio(spark, sf_dir):
    """Build the ratio, store it as CSV with its mean, read both, merge with mean fill."""
    root = session.scratch_path(spark, "positive-ratio")
    made = aggregates.positive_ratio(bindings.item_feedback(spark, sf_dir), "item_sid", "interaction")
    snapshots.write_csv(made.select("item_sid", "positive_ratio"), root)
    stored = snapshots.read_csv(spark, root, "item_sid bigint, positive_ratio double")
    snapshots.write_json(snapshots.mean_info(stored, ["positive_ratio"]), f"{root}.info")
    mean = snapshots.read_json(spark, f"{root}.info", "feature string, mean double").first()["mean"]
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_sid"))
    merged = features.positive_ratio_feature(stored, "item_sid", mean=mean).apply(items)
    return merged.withColumn("positive_ratio", F.round("positive_ratio", 6))


@query(
    "feature_badges",
    f"""select c_custkey, click, error, purchase, signup, "view"
from customer left join (select user_id, {_FLAGS} from events group by 1) on user_id = c_custkey""",
)
def feature_badges(spark, sf_dir):
    """Discover the badges, build the flags, store them, merge them."""
    root = session.scratch_path(spark, "badges")
    source = bindings.user_badges(spark, sf_dir)
    names = features.badge_names(source, "badge_type")
    snapshots.write_parquet(features.badge_flags(source, "account_sid", "badge_type", names), root)
    stored = snapshots.read_parquet(spark, root).withColumnRenamed("account_sid", "c_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return features.badge_feature(stored, "c_custkey", names).apply(customers)


@query("feature_badge_rows", "select distinct user_id as account_sid, event_type as badge from events")
def feature_badge_rows(spark, sf_dir):
    """Badges as rows, for any number of different ones."""
    return features.badge_rows(bindings.user_badges(spark, sf_dir), "account_sid", "badge_type")


@query(
    "feature_text_length",
    """select l.doc_id, coalesce(n, 0)::int as intro_len from labels l
left join (select doc_id, length(text) as n from documents where length(text) > 0) d on d.doc_id = l.doc_id""",
)
def feature_text_length(spark, sf_dir):
    root = session.scratch_path(spark, "text-length")
    made = features.text_length_table(bindings.item_introductions(spark, sf_dir), "account_sid", "item_introduction")
    snapshots.write_parquet(made, root)
    stored = snapshots.read_parquet(spark, root).withColumnRenamed("account_sid", "doc_id")
    return features.text_length_feature(stored, "doc_id").apply(table(spark, sf_dir, "labels").select("doc_id"))


@query(
    "item_content",
    """select l_suppkey as account_sid, p_type as code, string_agg(p_name, ' ' order by p_name) as tag_names
from lineitem join part on l_partkey = p_partkey left join supplier on s_suppkey = l_suppkey
where s_acctbal > 0 and l_discount > 0.05 group by all""",
)
def item_content(spark, sf_dir):
    """Part names per supplier and part type, written by type and read back."""
    path = session.scratch_path(spark, "item-content")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_suppkey").alias("account_sid"), "l_discount")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("code"), F.col("p_name").alias("name")
    )
    accounts = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("account_sid"), "s_acctbal")
    content = documents.item_content(
        lines.join(parts, "l_partkey"), accounts, "s_acctbal > 0 and l_discount > 0.05", "account_sid", "code", "name"
    )
    documents.write_item_content(content, path, "code")
    return spark.read.parquet(path).select("account_sid", "code", "tag_names")


_TERMS_SQL = """words as (select regexp_replace(p_name, '\\s', '', 'g') as w, p_name as keyword from part),
chars as (select substr(w, i::int, 1) as token from (select w, unnest(range(1, length(w) + 1)) as i from words)),
pairs as (select substr(w, i::int, 2) as cooccur from (select w, unnest(range(1, length(w))) as i from words)),
token2count as (select token, count(*) as n from chars group by 1),
cooccur2count as (select cooccur, count(*) as n from pairs group by 1),
terms as (select cooccur, c.n::double / (select sum(n) from token2count) * log2(c.n::double / t.n) as term
          from cooccur2count c join token2count t on t.token = substr(cooccur, 1, 1)),
bounds as (select keyword, w, length(w) as len, f.term as first_term, l.term as last_term
           from (select distinct keyword, w from words)
           left join terms f on f.cooccur = substr(w, 1, 2) left join terms l on l.cooccur = substr(w, greatest(length(w) - 1, 1), 2)),
limits as (select len,
             -max(first_term) filter (where first_term < 0)
               + (max(first_term) filter (where first_term < 0) - min(first_term) filter (where first_term < 0))
                 * (case when len > 5 then 1 else 5 end) / 99.0 as ft,
             -max(last_term) filter (where last_term < 0)
               + (max(last_term) filter (where last_term < 0) - min(last_term) filter (where last_term < 0))
                 * (case when len > 5 then 1 else 5 end) / 99.0 as lt
           from bounds where len >= 3 group by len)"""


@query(
    "term_thresholds",
    f"""with {_TERMS_SQL}
select len::int as length, round(ft, 8) as first_threshold, round(lt, 8) as last_threshold from limits""",
)
def term_thresholds(spark, sf_dir):
    limits = terms.term_thresholds(table(spark, sf_dir, "part"), "p_name")
    return limits.select("length", *[F.round(c, 8).alias(c) for c in ("first_threshold", "last_threshold")])


@query(
    "refine_keywords",
    f"""with {_TERMS_SQL},
cuts as (select keyword, w, coalesce(-first_term < ft, false) as drop_first, coalesce(-last_term < lt, false) as drop_last
         from bounds left join limits using (len))
select keyword, drop_first, drop_last,
       substr(w, 1 + drop_first::int, length(w) - drop_first::int - drop_last::int) as refined from cuts""",
)
def refine_keywords(spark, sf_dir):
    return terms.refine_keywords(table(spark, sf_dir, "part"), "p_name")


_SHORT = "select substr(replace(p_name, ' ', ''), 1 + p_partkey % 7, p_partkey % 6) as keyword from part"
_SHORT_SQL = _TERMS_SQL.replace(
    "select regexp_replace(p_name, '\\s', '', 'g') as w, p_name as keyword from part", f"select keyword as w, keyword from ({_SHORT})"
)


@query(
    "refine_short_keywords",
    f"""with {_SHORT_SQL},
cuts as (select keyword, w, coalesce(-first_term < ft, false) as drop_first, coalesce(-last_term < lt, false) as drop_last
         from bounds left join limits using (len))
select keyword, drop_first, drop_last,
       substr(w, 1 + drop_first::int, length(w) - drop_first::int - drop_last::int) as refined from cuts""",
)
def refine_short_keywords(spark, sf_dir):
    """Keywords of none to five characters: those too short for terms stay as they are."""
    whole = F.regexp_replace("p_name", " ", "")
    short = F.substring(whole, (F.col("p_partkey") % 7 + 1).cast("int"), (F.col("p_partkey") % 6).cast("int"))
    return terms.refine_keywords(table(spark, sf_dir, "part").select(short.alias("keyword")), "keyword")


@query(
    "short_keyword_terms",
    f"""with {_SHORT_SQL},
pos as (select keyword, w, unnest(range(1, length(w))) as i from (select distinct keyword, w from words)),
found as (select keyword, i, term from pos join terms on cooccur = substr(w, i::int, 2))
select k.keyword, coalesce(round(-sum(term), 8), 0.0) as entropy, count(term) as n,
       round(max(term) filter (where i = 1), 10) as first_term,
       round(max(term) filter (where i = length(k.keyword) - 1), 10) as last_term
from (select distinct keyword from words) k left join found f on f.keyword = k.keyword group by 1""",
)
def short_keyword_terms(spark, sf_dir):
    """Entropy and outer terms of the same keywords."""
    whole = F.regexp_replace("p_name", " ", "")
    short = F.substring(whole, (F.col("p_partkey") % 7 + 1).cast("int"), (F.col("p_partkey") % 6).cast("int"))
    words = table(spark, sf_dir, "part").select(short.alias("keyword"))
    made = keywords.keyword_terms(words, "keyword", keywords.pair_terms(keywords.frequency_tables(words, "keyword")))
    ends = keywords.first_and_last_term(made)
    rounded = {"entropy": F.round("entropy", 8), "first_term": F.round("first_term", 10), "last_term": F.round("last_term", 10)}
    return ends.withColumns(rounded).select("keyword", "entropy", F.size("terms").cast("bigint").alias("n"), "first_term", "last_term")


@query(
    "serving_publish",
    """select c_custkey, c_name, n_orders, round(spent, 2) as spent, n_events, 'v1' as source, 1.5::double as boost
from customer
left join (select o_custkey, count(*) as n_orders, sum(o_totalprice) as spent from orders group by 1) on o_custkey = c_custkey
left join (select user_id, count(*) as n_events from events group by 1) on user_id = c_custkey""",
)
def serving_publish(spark, sf_dir):
    served = ServingTable(spark, session.scratch_path(spark, "serving"), ["c_custkey"])
    ids = {"c_custkey": table(spark, sf_dir, "customer").select("c_custkey", "c_name")}
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("spent")
    )
    events = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n_events"))
    docs = documents.serving_publish(
        served,
        ids,
        [orders, events],
        ["c_custkey", "c_name", "n_orders", "spent", "n_events", "not_there"],
        {"source": "v1", "boost": 1.5},
        keep=2,
    )
    return docs.withColumn("spent", F.round("spent", 2))
