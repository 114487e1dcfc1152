"""Rules for the library's source and plans."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry_points

LIBRARY = sorted((Path(__file__).resolve().parents[1] / "larder").rglob("*.py"))

# Driver-side reads that are bounded by a schema, a model or a single row.
ALLOWED = {"model.py": {".toPandas("}}


@pytest.mark.parametrize("path", LIBRARY, ids=lambda p: p.name)
def test_nothing_is_pulled_to_the_driver(path):
    source = path.read_text()
    for call in (".collect(", ".toPandas(", ".toLocalIterator(", "localCheckpoint", ".crossJoin(", ".rdd"):
        if call not in ALLOWED.get(path.name, set()):
            assert call not in source, f"{call} in {path}"


@pytest.mark.parametrize("path", LIBRARY, ids=lambda p: p.name)
def test_every_gathered_row_states_its_bound(path):
    """A list that an aggregate gathers for the driver is a collect by another name: what bounds it stands near."""
    lines = path.read_text().splitlines()
    for number, line in enumerate(lines):
        if re.search(r"collect_(list|set)\(.*\.first\(\)", line):
            near = " ".join(lines[max(0, number - 6) : number + 1])
            assert re.search(r"at most|one row per|a row per", near), f"{path.name}:{number + 1}: {line.strip()}"


@pytest.mark.parametrize("path", LIBRARY, ids=lambda p: p.name)
def test_every_broadcast_states_its_bound(path):
    lines = path.read_text().splitlines()
    for number, line in enumerate(lines):
        if "F.broadcast(" in line:
            near = " ".join(lines[max(0, number - 14) : number + 2])
            assert re.search(r"at most|one row per|may be broadcast|hence the broadcast|hot_keys", near), line


SQL_ONLY = ["labeled_interactions", "pit_join", "mart_dataset", "term_thresholds", "inflate_classes", "merge_aggregate",
            "badge_onehot", "bitmap_to_ranges", "sample_training", "assign_vector_ids", "merge_documents", "embed_text", "collect_tag_chunks"]


@pytest.mark.parametrize("name", SQL_ONLY)
def test_no_python_worker_in_relational_plans(spark, sf_dir, name):
    plan = entry_points.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(("name", "most"), [("mart_dataset", 8), ("pit_join", 4), ("join_hot_keys", 4)])
def test_plans_scan_little(spark, sf_dir, name, most):
    """Labels, ratios and hot keys are written once and read, not derived again for every use."""
    plan = entry_points.queries()[name](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") <= most
