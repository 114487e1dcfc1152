"""Run manifest: one appended row per finished task run."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources import files

# Fixed value: the start of time for a job that never ran.
DEFAULT_START = "20190101_000000_000000"

MANIFEST_SCHEMA = "job_id string, run_id string, run_snapshot string, task_id string, body string"


def record_run(
    spark: SparkSession, root: str, job_id: str, run_id: str, run_snapshot: str, task_id: str, body: Mapping[str, Any]
) -> None:
    """Save the header and body of a run.  Recording a run again replaces it."""
    row = (job_id, run_id, run_snapshot, task_id, json.dumps(dict(body), ensure_ascii=False, default=str))
    path = f"{root}/job={job_id}/task={task_id}/{run_snapshot}"
    spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(path)


def read_runs(spark: SparkSession, root: str, job_id: str | None = None, task_id: str | None = None) -> DataFrame:
    """Recorded runs, of a job and task if given; empty if there are none.

    Only the folders of that job and task are listed and read.
    """
    wanted = [f"job={job_id}"] if job_id is not None else files.child_directories(spark, root)
    folders = [
        f"{root}/{job}/{task}"
        for job in wanted
        for task in files.child_directories(spark, f"{root}/{job}")
        if task_id is None or task == f"task={task_id}"
    ]
    if not folders:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json([f"{folder}/*" for folder in folders])


def latest_run(runs: DataFrame, job_id: str, task_id: str) -> DataFrame:
    """The newest run of a task as one row, or none."""
    mine = runs.filter((F.col("job_id") == job_id) & (F.col("task_id") == task_id))
    return mine.orderBy(F.col("run_snapshot").desc(), F.col("run_id").desc()).limit(1)


def previous_end(runs: DataFrame, job_id: str, task_id: str, field: str = "end_date") -> DataFrame:
    """One row: the largest recorded end of a task, or the default start."""
    mine = runs.filter((F.col("job_id") == job_id) & (F.col("task_id") == task_id))
    end = F.max(F.get_json_object("body", f"$.{field}"))
    return mine.agg(F.coalesce(end, F.lit(DEFAULT_START)).alias("previous_end"))


def previous_end_value(spark: SparkSession, root: str, job_id: str, task_id: str) -> str:
    return previous_end(read_runs(spark, root, job_id, task_id), job_id, task_id).first()["previous_end"]
