"""The pipeline's stages on small inputs, each against what its input asks for."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from larder.llm import quality, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two hundred texts of invented words, some toxic, copied, near copies, low in quality or with secrets."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 9)))
    texts = {i: [word() for _ in range(rng.randint(60, 120))] for i in range(200)}
    insults = ["grumfel", "snorvik"]
    toxic = [i for i in texts if i % 5 == 0]
    for i in toxic:
        for _ in range(3):
            texts[i].insert(rng.randrange(40), rng.choice(insults))
    rows = {i: " ".join(ws) for i, ws in texts.items()}
    rows[201] = rows[1]
    rows[202] = " ".join([*texts[2][:30], "changed", *texts[2][31:]])
    rows[203], rows[204], rows[205], rows[206] = None, "", "too short", "again and again it was " * 20
    rows[207] = rows[3].replace(" ", " $$$ ")
    rows[11] += " password=aB3dE6gH9jK2mN5p"
    for i in (12, 13, 14):
        rows[i] += " password=zY8xW7vU6tS5rQ4p"
    path = str(tmp_path_factory.mktemp("pipeline"))
    frame = [(i, t, "en", f"s{i % 7}", len(t or "")) for i, t in rows.items()]
    spark.createDataFrame(frame, "doc_id long, text string, lang string, source string, n_chars long").coalesce(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, toxic


def test_stages(spark, tables):
    path, rows, toxic = tables
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == COLUMNS
        seen[name] = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(list(seen[name].values()), docs.schema)
    assert set(seen["quality_rules"]) == set(rows) - {203, 204, 205, 206, 207}
    left = set(seen["quality_rules"])
    assert left - set(seen["toxicity"]) >= {i for i in toxic} and len(left - set(seen["toxicity"]) - set(toxic)) <= 1
    assert set(seen["toxicity"]) - set(seen["near_duplicates"]) == {201, 202}
    out = seen["secret_scan"]
    assert set(out) == set(seen["near_duplicates"])
    assert "aB3dE6" not in out[11].text and out[11].text.endswith("[SECRET]") and out[11].n_chars == len(out[11].text)
    for i in set(out) - {11}:
        assert (out[i].text, out[i].n_chars) == (rows[i], len(rows[i]))


def test_run_is_all_stages(spark, tables):
    path, rows, toxic = tables
    packed = corpus_pipeline.run(spark, path).collect()
    assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(packed[0].asDict())
    assert {r.doc_id for r in packed} <= set(rows) - set(toxic) - {201, 202, 203, 204, 205, 206, 207}
    assert len({r.doc_id for r in packed}) >= 158


def test_awkward_rows(spark, awkward, nothing, sf_dir):
    for frame in (awkward.selectExpr(*COLUMNS[:4], "1L as n_chars", "kept", "named_struct('a', 1) as more"), nothing.selectExpr(*COLUMNS[:4], "1L as n_chars")):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == frame.columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).columns[:2] == ["doc_id", "piece"]


def test_repeated_rows_leave_one(spark, awkward, sf_dir):
    docs = awkward.selectExpr(*COLUMNS[:4], "1L as n_chars")
    kept = corpus_pipeline.no_near_copies(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, 1, 4, 5, 8, 9]


def test_whole_tables(spark, sf_dir, docs):
    kept = corpus_pipeline.quality_rules(spark, docs, sf_dir)
    want = {r.doc_id for r in quality.ledger(docs).filter(quality.passes(2)).collect()}
    assert {r.doc_id for r in kept.collect()} == want
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = {r.doc_id for r in toxicity.scores(docs, labels).filter("predicted = 0").collect()}
    assert {r.doc_id for r in corpus_pipeline.not_toxic(spark, docs, sf_dir).collect()} == clean
