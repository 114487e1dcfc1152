"""Set operations, sampling, splitting, inflation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bindings, query, table
from larder import session
from larder.operators import sampling


@query(
    "union_all",
    """select id, kind from (select c_custkey as id, 'customer' as kind from customer
union all select s_suppkey, 'supplier' from supplier union all select c_custkey, 'customer' from customer)""",
)
def union_all(spark, sf_dir):
    """Columns are matched by name, whatever their order; copies are kept."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"))
    suppliers = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"))
    return sampling.union_all(customers, suppliers, customers)


@query(
    "subtract",
    "select distinct user_id, event_type from events where value <= 150 except select user_id, event_type from events where value > 150",
)
def subtract(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    small = events.filter("value <= 150").select("user_id", "event_type")
    return sampling.subtract(small, events.filter("value > 150").select("event_type", "user_id"))


@query(
    "subtract_keep_duplicates",
    "select user_id, event_type from events where value <= 150 except all select user_id, event_type from events where value > 150",
)
def subtract_keep_duplicates(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    small = events.filter("value <= 150").select("user_id", "event_type")
    return sampling.subtract(small, events.filter("value > 150").select("event_type", "user_id"), keep_duplicates=True)


@query("sample_negatives", f"select event_id, user_id from events where {bindings.sql_sample(42, 0.1, 'event_id')}")
def sample_negatives(spark, sf_dir):
    return sampling.sample_by_key(table(spark, sf_dir, "events").select("event_id", "user_id"), ["event_id"], 0.1)


@query("sample_small_fraction", f"select l_orderkey, l_partkey, l_suppkey from lineitem where {bindings.sql_sample(3, 0.0004, 'l_orderkey', 'l_partkey', 'l_suppkey')}")
def sample_small_fraction(spark, sf_dir):
    """A fraction far below a thousandth, as samples of large tables have."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return sampling.sample_by_key(rows, ["l_orderkey", "l_partkey", "l_suppkey"], 0.0004, seed=3)


@query("sample_test", f"select doc_id, lang from documents where {bindings.sql_sample(7, 0.333, 'doc_id')}")
def sample_test(spark, sf_dir):
    return sampling.sample_by_key(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["doc_id"], 0.333, seed=7)


@query(
    "sample_training",
    f"""select o_orderkey from orders order by {bindings.sql_hash(42, 'o_orderkey')}, o_orderkey
limit (select (0.37 * count(*))::bigint - case when (0.37 * count(*))::bigint > 0.37 * count(*) then 1 else 0 end from orders)""",
)
def sample_training(spark, sf_dir):
    """Exactly ``int(factor * n)`` rows."""
    return sampling.sample_exact(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 0.37)


_PHASE = f"""case when {bindings.sql_sample(42, 0.1, 'doc_id')} then 'test'
  when {bindings.sql_sample(43, 0.09, 'doc_id')} then 'validation' else 'train' end"""


@query("split_train_dev_test", f"select {_PHASE} as phase, doc_id from documents")
def split_train_dev_test(spark, sf_dir):
    """Phases in one pass, written to one directory each and read back."""
    path = session.scratch_path(spark, "phases")
    sampling.write_phases(sampling.split_phases(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"]), path)
    return spark.read.parquet(path)


@query(
    "inflate_classes",
    """with c as (select lang, count(*) as n from documents group by 1),
r as (select lang, floor(0.5 * ((select count(*) from documents) / 4.0) / n)::bigint + 1 as rate from c)
select doc_id, lang, copy::int as copy from documents join r using (lang), range(1, 10) x(copy)
where lang in ('de', 'en', 'es', 'fr') and copy <= rate""",
)
def inflate_classes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.inflate_classes(docs, "lang", ["de", "en", "es", "fr"])


@query(
    "inflation_rates",
    """select source, count(*) as n, floor(0.5 * ((select count(*) from documents) / 3.0) / count(*))::int + 1 as rate
from documents where source in ('src0', 'src1', 'src2') group by 1""",
)
def inflation_rates(spark, sf_dir):
    """Copies per listed category; rows of other categories only count in the mean."""
    return sampling.inflation_rates(table(spark, sf_dir, "documents"), "source", ["src0", "src1", "src2"])


@query(
    "phase_counts",
    f"select {_PHASE} as phase, count(*) as n, count(distinct lang) as langs from documents group by 1",
)
def phase_counts(spark, sf_dir):
    phased = sampling.split_phases(table(spark, sf_dir, "documents"), ["doc_id"])
    return sampling.phase_counts(phased, extra={"langs": "lang"})
