"""Text vectors, merged vectors, neighbours, vector corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bindings, query, table
from larder import session
from larder.operators import aggregates, filters, sampling, vector_index, vectors
from larder.plans import corpus

_EMBED_SQL = """tokens as (select doc_id, source, lang, unnest(regexp_extract_all(text, '[^ \t\n\r\f\v]+')) as word from documents),
buckets as (select doc_id, source, lang, ('0x' || substr(md5(word), 1, 8))::bigint % 64 as pos, count(*) as c from tokens group by all),
norms as (select doc_id, sqrt(sum(c * c)) as norm from buckets group by 1),
embedded as (select doc_id, source, lang, pos, (c / norm)::float::double as value from buckets join norms using (doc_id))"""


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")


@query("embed_text", f"with {_EMBED_SQL} select doc_id, pos::int as pos, round(value, 5) as value from embedded")
def embed_text(spark, sf_dir):
    """Non-zero elements of the default text vectors."""
    made = vectors.embed_text(_documents(spark, sf_dir), ["doc_id"], {"text": "vector"})
    rows = made.select("doc_id", F.posexplode("vector").alias("pos", "value")).filter("value <> 0")
    return rows.withColumn("value", F.round(F.col("value").cast("double"), 5))


@query(
    "embed_several_fields",
    """select conv_id, turn, len(regexp_extract_all(text, '[^ \t\n\r\f\v]+')) > 0 as has_text, 1.0::double as role_norm from conversations""",
)
def embed_several_fields(spark, sf_dir):
    """Two text fields, two vector columns; vectors have length 1."""
    made = vectors.embed_text(
        table(spark, sf_dir, "conversations"), ["conv_id", "turn"], {"text": "text_vector", "role": "role_vector"}, batch_size=8
    )

    def norm(c):
        return F.round(F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))), 3)

    return made.select("conv_id", "turn", (norm("text_vector") > 0).alias("has_text"), norm("role_vector").alias("role_norm"))


@query(
    "history_vectors",
    f"""with {_EMBED_SQL}, sizes as (select lang, source, count(*) as n from documents group by all)
select lang, source, pos::int as pos, round(sum(value) / max(n), 6) as value from embedded join sizes using (lang, source) group by all""",
)
def history_vectors(spark, sf_dir):
    """Mean text vector per source and language, one directory per language."""
    path = session.scratch_path(spark, "history")
    made = vectors.history_vectors(_documents(spark, sf_dir), ["lang", "source"], "text", spread_by=["doc_id"])
    filters.write_category_slices(made, path, "lang")
    rows = spark.read.parquet(path).select("lang", "source", F.posexplode("vector").alias("pos", "value"))
    return rows.filter("value <> 0").withColumn("value", F.round("value", 6))


@query(
    "merge_vectors",
    f"""with past as (select (vec_id // 2) * 2 as vec_id, label, i, avg(embedding[i]::double) as v
  from embeddings, range(1, 65) r(i) group by all),
ids as (select vec_id, label, row_number() over (partition by label order by {bindings.sql_hash(42, 'vec_id')}, vec_id) - 1 as vid
        from embeddings)
select e.vec_id, e.label, vid, (r.i - 1)::int as pos,
       round((e.embedding[r.i]::double + coalesce(p.v, e.embedding[r.i]::double)) / 2, 6) as value
from embeddings e join ids using (vec_id, label), range(1, 65) r(i)
left join past p on p.vec_id = e.vec_id and p.label = e.label and p.i = r.i""",
)
def merge_vectors(spark, sf_dir):
    """Initial vectors merged with the mean of their history, over all labels."""
    initial = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))
    past = initial.withColumn("vec_id", F.expr("vec_id div 2 * 2"))
    history = aggregates.vector_mean(past, ["vec_id", "label"], "vector")
    merged = vectors.merge_vectors(initial, history, "vec_id", ["label"])
    rows = merged.select("vec_id", "label", "vid", F.posexplode("vector").alias("pos", "value"))
    return rows.withColumn("value", F.round("value", 6))


def _knn_sql(queries: str, k: int) -> str:
    return f"""with q as ({queries}),
scored as (select q.id::varchar as query, e.vec_id::varchar as item, list_inner_product(q.v, e.embedding::double[]) as score
           from q, embeddings e)
select query, item, round(score, 5) as score, rank::int as rank from
(select *, row_number() over (partition by query order by score desc, item) as rank from scored) where rank <= {k}"""


_CENTRES_SQL = """select label as id, list(x order by pos) as v from (select label, pos, avg(x) as x from
  (select label, unnest(embedding::double[]) as x, unnest(range(64)) as pos from embeddings) group by all) group by 1"""


def _neighbours(found):
    return found.withColumn("score", F.round("score", 5))


@query("knn_inner_product", _knn_sql(_CENTRES_SQL, 10))
def knn_inner_product(spark, sf_dir):
    """The ten best vectors for the mean vector of each label."""
    embeddings = table(spark, sf_dir, "embeddings")
    centres = aggregates.vector_mean(embeddings, ["label"], "embedding")
    items = embeddings.withColumnRenamed("embedding", "vector")
    return _neighbours(vectors.knn_inner_product(centres, items, 10, "label", "vec_id"))


def _index(spark, items):
    return vector_index.VectorIndex(spark, session.scratch_path(spark, "index")).build(items, "vec_id")


@query("knn_all_vectors", _knn_sql("select vec_id as id, embedding::double[] as v from embeddings", 3))
def knn_all_vectors(spark, sf_dir):
    """The three best vectors for every vector, cell by cell as far as their bounds reach."""
    items = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    return _neighbours(_index(spark, items).search_exact(items, 3, "vec_id", block_rows=300, query_rows=1024))


@query("knn_all_blocks", _knn_sql("select vec_id as id, embedding::double[] as v from embeddings", 3))
def knn_all_blocks(spark, sf_dir):
    """The same without an index, over several blocks of each side."""
    items = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    found = vectors.knn_inner_product(items, items, 3, "vec_id", "vec_id", block_rows=300, query_rows=1024)
    return _neighbours(found)


def _mixed_lengths(spark, sf_dir):
    """The given vectors, some up to nine times as long as others."""
    longer = F.transform("embedding", lambda x: x.cast("double") * (1 + F.col("vec_id") % 9))
    return table(spark, sf_dir, "embeddings").select("vec_id", longer.alias("vector"))


@query(
    "knn_approx_recall",
    "select true as enough, true as few, count(*) as queries from embeddings where vec_id % 20 = 0",
)
def knn_approx_recall(spark, sf_dir):
    """Of vectors of mixed length, the index finds nine of ten true neighbours and reads less than a quarter of the items."""
    items = session.materialise(_mixed_lengths(spark, sf_dir), "mixed")
    queries = items.filter("vec_id % 20 = 0")
    truth = session.materialise(vectors.knn_inner_product(queries, items, 10, "vec_id", "vec_id"), "truth")
    session.release(spark)
    index = _index(spark, items)
    found = session.materialise(index.search(queries, 10, "vec_id", block_rows=100, query_rows=30), "found")
    session.release(spark)
    sizes = spark.read.parquet(f"{index.path}/cells")
    read = index.probe(queries, "vec_id").join(sizes, "cell").groupBy("query").agg(F.sum("n").alias("n"))
    share = read.agg(F.avg("n") / items.agg(F.count("*")).scalar()).scalar()
    made = vectors.recall(found, truth)
    return made.select((F.col("recall") >= 0.9).alias("enough"), (share < 0.25).alias("few"), found.agg(F.count_distinct("query")).scalar().alias("queries"))


@query("knn_approx")
def knn_approx(spark, sf_dir):
    """The ten best vectors per label mean among the cells nearest to it."""
    embeddings = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    centres = aggregates.vector_mean(embeddings, ["label"], "vector")
    return _index(spark, embeddings).search(centres, 10, "label")


@query("knn_exact_index", _knn_sql(_CENTRES_SQL, 10))
def knn_exact_index(spark, sf_dir):
    """The exact neighbours by cells and their bounds, cut into small blocks."""
    embeddings = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    centres = aggregates.vector_mean(embeddings, ["label"], "vector")
    return _neighbours(_index(spark, embeddings).search_exact(centres, 10, "label", block_rows=50))


_LANGS = ["de", "en", "es", "fr"]
_CORPUS_SQL = f"""with c as (select lang, count(*) as n from train group by 1),
r as (select lang, floor(0.5 * ((select count(*) from train) / 4.0) / n)::bigint + 1 as rate from c)"""
_PHASED = f"""phased as (select doc_id, lang, doc_id % 10 as reference,
  case when {bindings.sql_sample(42, 0.1, 'doc_id')} then 'test'
       when {bindings.sql_sample(43, 0.09, 'doc_id')} then 'validation' else 'train' end as phase from documents)"""


@query(
    "vector_corpus",
    f"""with {_PHASED}, train as (select * from phased where phase = 'train'),
{_CORPUS_SQL.removeprefix('with ')},
rows as (select doc_id, lang, reference, phase, copy from train join r using (lang), range(1, 10) x(copy) where copy <= rate
         union all select doc_id, lang, reference, phase, 1 from phased where phase <> 'train'),
static as (select label, lang, avg(embedding[1]::double) as v from embeddings join documents on doc_id = vec_id group by all)
select doc_id, rows.lang, phase, copy::int as copy, round(e.embedding[1]::double, 6) as adhoc, round(s.v, 6) as static
from rows left join embeddings e on e.vec_id = doc_id left join static s on s.label = reference and s.lang = rows.lang""",
)
def vector_corpus(spark, sf_dir):
    """Split by language-balanced phases, with a vector by id and one by
    (reference, language); written by phase and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", (F.col("doc_id") % 10).cast("int").alias("reference"))
    adhoc = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")
    labelled = adhoc.join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    static = aggregates.vector_mean(labelled.withColumnRenamed("label", "reference"), ["reference", "lang"], "embedding")
    rows = corpus.vector_corpus(docs, "lang", _LANGS, "doc_id", adhoc, static, ["reference", "lang"], unique=True)
    path = session.scratch_path(spark, "corpus")
    sampling.write_phases(rows, path)
    return spark.read.parquet(path).select(
        "doc_id",
        "lang",
        "phase",
        "copy",
        F.round(F.col("adhoc_vector")[0].cast("double"), 6).alias("adhoc"),
        F.round(F.col("static_vector")[0], 6).alias("static"),
    )
