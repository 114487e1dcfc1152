"""Toxicity: held-out accuracy, label use, the label model, odd rows."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from larder.llm import toxicity


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


INSULTS = ["grumfel", "snorvik", "plaxidor", "quibblet"]


@pytest.fixture(scope="module")
def made(spark):
    """Texts of invented words; toxic ones hold two to five invented insults."""
    rng = random.Random(4)
    common = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows = []
    for i in range(1500):
        ws, toxic = [rng.choice(common) for _ in range(rng.randint(5, 60))], int(rng.random() < 0.15)
        for _ in range(rng.randint(2, 5) if toxic else 0):
            ws.insert(rng.randrange(len(ws)), rng.choice(INSULTS) + rng.choice(["", "s", "!", "."]))
        rows.append((i, " ".join(ws), toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_held_out_accuracy(made):
    rows = toxicity.scores(made, made.select("doc_id", "toxic")).join(made, "doc_id").collect()
    assert len(rows) == 1500
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)
    held = [r for r in rows if r.held_out]
    caught = sum(r.predicted for r in held if r.toxic) / sum(r.toxic for r in held)
    assert caught > 0.95 and not any(r.predicted for r in held if not r.toxic)


def test_many_rare_insults(spark):
    """Two hundred insults, one to a toxic text: none is in a hundred and fiftieth of the toxic texts on average."""
    rng = random.Random(6)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    common = [word("aeioulmnrst", rng.randint(2, 9)) for _ in range(400)]
    insults = [word("bcdfghjkpqvwxyz", rng.randint(6, 9)) for _ in range(200)]
    rows = []
    for i in range(18_000):
        ws, toxic = [rng.choice(common) for _ in range(rng.randint(5, 20))], int(i % 3 == 0)
        if toxic:
            ws.insert(rng.randrange(len(ws)), rng.choice(insults))
        rows.append((i, " ".join(ws), toxic))
    made = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    held = [r for r in toxicity.scores(made, made.select("doc_id", "toxic")).join(made, "doc_id").collect() if r.held_out]
    caught = sum(r.predicted for r in held if r.toxic) / sum(r.toxic for r in held)
    lost = sum(r.predicted for r in held if not r.toxic) / sum(1 - r.toxic for r in held)
    assert caught > 0.95 and lost < 0.01, (caught, lost)


def test_held_out_labels_are_never_read(made):
    labels = made.select("doc_id", "toxic")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    want = {r.doc_id: r.score for r in toxicity.scores(made, labels).collect()}
    assert {r.doc_id: r.score for r in toxicity.scores(made, turned).collect()} == pytest.approx(want)


def test_whole_table(spark, sf_dir, texts):
    rows = toxicity.QUERIES["op5_toxicity"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)


def test_label_model_finds_accuracies(spark):
    """Unlabelled votes of known accuracies, and a copied voter, which must count less."""
    rng = random.Random(1)
    rows = []
    for _ in range(4000):
        toxic = rng.random() < 0.3
        votes = sum((rng.random() < (0.8 if toxic else 0.05)) << v for v in range(4))
        votes |= (votes >> 3 & 1) << 4
        rows.append((votes, int(toxic) if rng.random() < 0.05 else None, 1))
    model = toxicity.fit_label_model(spark.createDataFrame(rows, "votes long, toxic int, n long"))
    assert abs(model.prior - 0.3) < 0.05
    assert all(abs(a - 0.8) < 0.15 and b < 0.15 for a, b in zip(model.toxic[:3], model.clean[:3], strict=True))
    assert max(model.weight[3:5]) < min(model.weight[:3]) and max(model.weight[3:5]) < 0.55


def test_odd_rows(spark, awkward, nothing, labels):
    rows = {r.doc_id: r for r in toxicity.scores(awkward, labels).collect()}
    assert len(rows) == 9 and rows[1].score == rows[2].score
    assert toxicity.scores(nothing, labels).collect() == []
    none = toxicity.scores(awkward, labels.filter("doc_id < 0")).collect()
    assert len(none) == 10 and {r.score for r in none} == {0.0}
