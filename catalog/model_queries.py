"""Training, scoring, evaluation, leaderboard, explanation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query, table
from larder import session
from larder.functions import text
from larder.operators import aggregates, model
from larder.sources import files, models, schemas, snapshots

FEATURES = ["n_chars", "n_words", "n_lines", "word_length", "digit_share"]


def judged_documents(spark, sf_dir):
    """Labelled documents with simple text features, over their whole texts."""
    body = F.col("text")
    words = F.size(text.tokens(body))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "n_chars",
        words.alias("n_words"),
        F.size(F.split(body, "\n")).alias("n_lines"),
        F.coalesce(F.try_divide(F.length(text.condense(body)).cast("double"), words.cast("double")), F.lit(0.0)).alias("word_length"),
        F.coalesce(
            F.try_divide(F.regexp_count(body, F.lit("[0-9]")).cast("double"), F.length(body).cast("double")), F.lit(0.0)
        ).alias("digit_share"),
    )
    return rows.join(table(spark, sf_dir, "labels"), "doc_id")


def _model_root(spark, sf_dir):
    """Where the models of these tables are: a rewritten table has another place."""
    tables = [f"{sf_dir}/{name}.parquet" for name in ("documents", "labels")]
    return f"{session.workspace(spark)}/larder/models/{files.fingerprint(spark, *tables)}"


def _train(spark, sf_dir):
    """Train on 80 % of the judged documents, with all trees, and save the model."""
    return models.train(judged_documents(spark, sf_dir), _model_root(spark, sf_dir), FEATURES, "quality", sampling_factor=0.8, sample_keys=["doc_id"])


def _saved(spark, sf_dir):
    """The judged documents and the newest model of these tables; the first who asks has it trained."""
    root = _model_root(spark, sf_dir)
    if not snapshots.complete_snapshots(spark, root):
        _train(spark, sf_dir)
    return judged_documents(spark, sf_dir), models.load(spark, root)


@query("train_ranker")
def train_ranker(spark, sf_dir):
    """Train and save a model, then judge the saved one, by its name, on the sources of all rows."""
    name = _train(spark, sf_dir)
    saved = models.load(spark, _model_root(spark, sf_dir), pinned=name)
    scored = saved.score(saved.check(judged_documents(spark, sf_dir)))
    return scored.groupBy("source").agg(
        F.count("*").alias("n"), F.avg("probability").alias("mean_probability"), F.sum("quality").alias("positives")
    )


@query(
    "model_snapshot",
    "select unnest(["
    + ", ".join(f"{{'name': 'f{n}', 'feature': '{f}', 'type': '{t}'}}" for n, (f, t) in enumerate(zip(FEATURES, ("bigint", "int", "int", "double", "double"), strict=True)))
    + "], recursive := true)",
)
def model_snapshot(spark, sf_dir):
    """The feature map and the schema that lie beside the newest model."""
    _, saved = _saved(spark, sf_dir)
    rows = [(new, old, saved.schema[old].dataType.simpleString()) for old, new in schemas.feature_name_map(saved.features).items()]
    return spark.createDataFrame(rows, "name string, feature string, type string")


@query("score_batch")
def score_batch(spark, sf_dir):
    rows, saved = _saved(spark, sf_dir)
    return saved.score(rows, threshold=0.6).select("doc_id", "quality", "probability", "prediction")


@query("evaluate_model")
def evaluate_model(spark, sf_dir):
    rows, saved = _saved(spark, sf_dir)
    return model.evaluate_scores(saved.score(rows), "quality")


@query(
    "evaluate_scores",
    """with s as (select quality, n_chars / (n_chars + 400.0) > 0.55 as p from documents join labels using (doc_id)),
c as (select count(*) filter (where quality = 1 and p) as true_positive, count(*) filter (where quality <> 1 and p) as false_positive,
       count(*) filter (where quality = 1 and not p) as false_negative, count(*) filter (where p) as predicted_positive, count(*) as n from s)
select *, round(true_positive / (true_positive + false_positive)::double, 8) as precision,
       round(true_positive / (true_positive + false_negative)::double, 8) as recall,
       round(2.0 * true_positive / (2.0 * true_positive + false_positive + false_negative), 8) as f1, 0.55::double as threshold from c""",
)
def evaluate_scores(spark, sf_dir):
    """Metrics of a table of scores at a threshold."""
    scored = judged_documents(spark, sf_dir).withColumn("probability", F.col("n_chars") / (F.col("n_chars") + 400.0))
    made = model.evaluate_scores(scored, "quality", 0.55)
    return made.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


_RECORD_SQL = """runs as (select source, row_number() over (order by source) as record_id,
    count(*) filter (where quality = 1 and n_chars > 500) as tp, count(*) filter (where quality <> 1 and n_chars > 500) as fp,
    count(*) filter (where quality = 1 and n_chars <= 500) as fn
  from documents join labels using (doc_id) group by 1),
records as (select record_id, source as domain_name, tp / nullif(tp + fp, 0)::double as p, tp / nullif(tp + fn, 0)::double as r from runs)"""
_RECORD_FIELDS = """record_id, 'ranking' as task_name, domain_name, round(2 / (1 / nullif(p, 0) + 1 / nullif(r, 0)), 8) as f1,
       '2024-02-01 ' || domain_name as record_time, 'gbt|rule' as model_name, printf('%.3f', p) as precision,
       printf('%.3f', r) as recall, case when domain_name like 'src1%' then '0.500' else '0.650' end as threshold"""


def run_records(spark, sf_dir):
    """A run per source: a length rule judged on the source's labels."""
    judged = judged_documents(spark, sf_dir).withColumn("guess", (F.col("n_chars") > 500).cast("int"))
    metrics = aggregates.classification_metrics(judged, "quality", "guess", ["source"])
    metrics = metrics.withColumn("threshold", F.when(~F.col("source").startswith("src1"), 0.65))
    start = F.to_json(F.struct(F.concat(F.lit("2024-02-01 "), F.col("source")).alias("start_time")))
    new = model.run_record(
        metrics, start, ["gbt", "rule"], {"task_name": F.lit("ranking"), "domain_name": F.col("source")}
    )
    none = spark.createDataFrame(
        [], "record_id bigint, snapshots string, models string, evaluations string, task_name string, domain_name string"
    )
    return model.append_records(none, new, ["domain_name"])


@query(
    "json_extract_metrics",
    f"""with {_RECORD_SQL} select {_RECORD_FIELDS} from records""",
)
def json_extract_metrics(spark, sf_dir):
    """Metrics, threshold and names read back from the JSON texts of the runs."""
    rows = model.read_metrics(run_records(spark, sf_dir)).drop("snapshots", "models", "evaluations")
    return rows.withColumn("f1", F.round("f1", 8))


@query(
    "leaderboard",
    f"""with {_RECORD_SQL}, top as (select *, 2 / (1 / nullif(p, 0) + 1 / nullif(r, 0)) as score from records
  order by score desc nulls last, record_id limit 7) select {_RECORD_FIELDS} from top""",
)
def leaderboard(spark, sf_dir):
    return model.leaderboard(run_records(spark, sf_dir), 7).withColumn("f1", F.round("f1", 8))


@query("explain_features")
def explain_features(spark, sf_dir):
    """Mean Shapley value of every feature and of every pair of features."""
    rows, saved = _saved(spark, sf_dir)
    return model.explain_features(saved.fitted, rows, FEATURES)


@query("explain_rows")
def explain_rows(spark, sf_dir):
    """Shapley values of every document."""
    rows, saved = _saved(spark, sf_dir)
    return model.explain_rows(saved.fitted, rows, FEATURES, ["doc_id"])


@query("permutation_importance")
def permutation_importance(spark, sf_dir):
    rows, saved = _saved(spark, sf_dir)
    return model.permutation_importance(saved.fitted, rows, FEATURES, "quality", "doc_id")


_JUDGED = "documents join labels using (doc_id)"


@query("scores_agree", f"select source, count(*) as n, 0::bigint as off, cast(sum(quality) as bigint) as positives from {_JUDGED} group by 1")
def scores_agree(spark, sf_dir):
    """Probabilities lie between 0 and 1, and predictions follow from them and the threshold."""
    rows, saved = _saved(spark, sf_dir)
    scored = model.score_batch(saved.fitted, rows, FEATURES, threshold=0.6)
    right = F.col("probability").between(0, 1) & (F.col("prediction") == (F.col("probability") > 0.6).cast("int"))
    return scored.groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(~right).alias("off"), F.sum("quality").cast("bigint").alias("positives")
    )


@query("evaluation_recomputed", f"select count(*) as n, 0::bigint as off from {_JUDGED}")
def evaluation_recomputed(spark, sf_dir):
    """The model's metrics against counts taken from its scores by hand."""
    rows, saved = _saved(spark, sf_dir)
    scored = session.materialise(model.score_batch(saved.fitted, rows, FEATURES), "scores")
    made = model.evaluate_scores(scored, "quality")
    said, good = F.col("probability") > 0.5, F.col("quality") == 1
    hits, wrong, missed = scored.agg(F.count_if(said & good)).scalar(), scored.agg(F.count_if(said & ~good)).scalar(), scored.agg(F.count_if(~said & good)).scalar()
    f1 = 2.0 * hits / (2.0 * hits + wrong + missed)
    same = (F.col("true_positive") == hits) & (F.abs(F.col("precision") - hits / (hits + wrong)) < 1e-9) & (F.abs(F.col("f1") - f1) < 1e-9)
    return made.select("n", F.when(same, 0).otherwise(1).cast("bigint").alias("off"))


@query("explanations_add_up", f"select count(*) as n, 0::bigint as off from {_JUDGED}")
def explanations_add_up(spark, sf_dir):
    """The Shapley values of a row and the mean margin are its margin: what is left over is the same for all rows."""
    rows, saved = _saved(spark, sf_dir)
    values = model.explain_rows(saved.fitted, rows, FEATURES, ["doc_id"])
    total = values.select("doc_id", sum(F.col(f) for f in FEATURES).alias("total"))
    scored = model.margins(saved.fitted, rows, FEATURES)
    left = session.materialise(scored.join(total, "doc_id").select((F.col("margin") - F.col("total")).alias("d")), "left-over")
    middle = left.agg(F.avg("d")).scalar()
    return left.agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.abs(F.col("d") - middle) > 1e-6, F.lit(True))).alias("off"))


@query("attributions_add_up", "select unnest([" + ", ".join(f"'{f}'" for f in FEATURES) + "]) as feature, true as adds_up")
def attributions_add_up(spark, sf_dir):
    """The pairs of a feature, itself included, add up to its own mean value."""
    rows, saved = _saved(spark, sf_dir)
    parts = session.materialise(model.explain_features(saved.fitted, rows, FEATURES), "attributions")
    own = parts.filter("other is null").select("feature", F.col("mean").alias("own"))
    pairs = parts.filter("other is not null").groupBy("feature").agg(F.sum("mean").alias("pairs"))
    return own.join(pairs, "feature").select("feature", (F.abs(F.col("own") - F.col("pairs")) < 1e-6).alias("adds_up"))


@query("importance_of_constant", "select 'digit_share' as feature, 0.0::double as f1_drop")
def importance_of_constant(spark, sf_dir):
    """Moving the values of a feature that does not vary in the rows changes nothing."""
    rows, saved = _saved(spark, sf_dir)
    level = rows.withColumn("digit_share", F.lit(0.01))
    return model.permutation_importance(saved.fitted, level, FEATURES, "quality", "doc_id").filter("feature = 'digit_share'")
