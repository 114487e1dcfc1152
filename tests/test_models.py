"""Models as snapshots."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from support import rows

from larder import session
from larder.operators import model
from larder.sources import files, models

NAMES = ["x", "y"]


@pytest.fixture(scope="module")
def judged(spark):
    made = spark.range(300).select("id", (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 5).cast("int").alias("y"))
    return made.withColumn("good", ((F.col("x") > 8) | (F.col("y") == 2)).cast("int"))


def test_a_saved_model_scores_as_the_fitted_one(spark, judged, root):
    fitted = model.train_ranker(judged, NAMES, "good", trees=5)
    name = models.save(spark, fitted, root, judged.select(*NAMES, "good").schema, NAMES, "good", "20240101_000000_000000")
    saved = models.load(spark, root)
    assert (saved.name, saved.features, saved.label, saved.schema) == (name, NAMES, "good", judged.select(*NAMES, "good").schema)
    columns = "id", "probability", "prediction"
    assert rows(saved.score(judged, 0.7).select(*columns)) == rows(model.score_batch(fitted, judged, NAMES, 0.7).select(*columns))
    with pytest.raises(FileExistsError):
        models.save(spark, fitted, root, judged.schema, NAMES, "good", name)


def test_newest_or_pinned(spark, judged, root):
    first = models.train(judged, root, NAMES, "good", "20240101_000000_000000", trees=1)
    second = models.train(judged, root, ["x"], "good", "20240102_000000_000000", trees=2)
    files.make_directory(spark, f"{root}/20240103_000000_000000/model")  # a training that was cut short
    assert models.load(spark, root).name == second and models.load(spark, root).features == ["x"]
    assert models.load(spark, root, pinned=first).features == NAMES
    with pytest.raises(FileNotFoundError):
        models.load(spark, root, pinned="20240103_000000_000000")
    with pytest.raises(FileNotFoundError):
        models.load(spark, f"{root}/nothing")


def test_rows_are_checked_against_the_model(spark, judged, root):
    models.train(judged, root, NAMES, "good", trees=1)
    saved = models.load(spark, root)
    assert saved.check(judged) is judged
    for bad in (judged.drop("y"), judged.withColumn("x", F.col("x").cast("string")), judged.withColumn("x", F.when(F.col("id") > 3, F.col("x")))):
        with pytest.raises(ValueError):
            saved.check(bad)


def test_a_rewritten_table_has_another_fingerprint(spark, judged, root):
    judged.write.parquet(f"{root}/t")
    before = files.fingerprint(spark, f"{root}/t")
    assert files.fingerprint(spark, f"{root}/t") == before
    judged.limit(10).write.mode("overwrite").parquet(f"{root}/t")
    assert files.fingerprint(spark, f"{root}/t") != before


def test_cells_train_the_trees_of_their_rows(spark):
    """Thresholds, leaves, rows of a node and scores are those of Spark's booster over the rows; it is given fewer rows."""
    made = spark.range(3000).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(997)) / 7.0 - 30).alias("x"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(5)).cast("int").alias("y"), F.lit(4.0).alias("same")
    )
    good = ((F.col("x") > 20.1) | (F.col("y") == 2)).cast("int")
    noisy = made.withColumn("good", F.when(F.col("id") % 11 == 0, 1 - good).otherwise(good))
    names = ["x", "y", "same"]
    fitted = model.train_ranker(noisy, names, "good", trees=6)
    plain = VectorAssembler(inputCols=names, outputCol="features")
    booster = GBTClassifier(labelCol="good", maxIter=6, maxDepth=model.MAX_DEPTH, stepSize=model.LEARNING_RATE, seed=model.SEED)
    whole = PipelineModel([plain, booster.fit(plain.transform(noisy))])
    mine, theirs = model.tree_nodes(fitted), model.tree_nodes(whole)
    assert mine[["tree", "node", "feature", "left", "right", "rows"]].equals(theirs[["tree", "node", "feature", "left", "right", "rows"]])
    for column in ("threshold", "value"):
        assert mine[column].to_numpy() == pytest.approx(theirs[column].to_numpy(), nan_ok=True)
    want = {r["id"]: r["p"] for r in whole.transform(noisy).select("id", vector_to_array("probability").getItem(1).alias("p")).collect()}
    got = {r["id"]: r["probability"] for r in model.score_batch(fitted, noisy, names).collect()}
    assert got == pytest.approx(want)
    # the booster counts what it is given: cells, of which there are far fewer than rows
    data = F.col("nodeData")
    fitted.stages[-1].save(path := session.scratch_path(spark, "model"))
    root = spark.read.parquet(f"{path}/data").filter(data["id"] == 0).select(data["rawCount"].alias("n")).first()["n"]
    assert root <= 32 * 5 * 2 < noisy.count()


@pytest.mark.parametrize("most", [1_000, 10_000])
def test_split_points_of_many_values_are_quantiles(spark, monkeypatch, most):
    monkeypatch.setattr(model, "CUT_VALUES", most)
    df = spark.range(6400).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).alias("y"))
    points = model.split_points(df, ["x", "y"])
    assert len(points["x"]) == 31 and points["y"] == [0.5, 1.5]
    # quantiles are right to one rank in CUT_VALUES, cuts by the values themselves to one value
    assert points["x"] == pytest.approx([200.0 * k for k in range(1, 32)], abs=1 + 6400 / most)
