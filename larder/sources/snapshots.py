"""Snapshot tables: one directory per run, readers take the newest complete one.

A snapshot directory is named after its UTC time (``YYYYMMDD_HHMMSS_ffffff``),
so name order is time order.  A snapshot counts only once Spark has written its
``_SUCCESS`` marker; a half-written directory is never read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources import files

# Fixed value: the name format of a snapshot.
SNAPSHOT_FORMAT = "%Y%m%d_%H%M%S_%f"


# JSON times keep their microseconds; the writer's default stops at milliseconds.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def snapshot_now() -> str:
    return datetime.now(timezone.utc).strftime(SNAPSHOT_FORMAT)


@dataclass(frozen=True)
class SnapshotPath:
    """Location of a snapshot table: base/zone/domain/schema_type/phase."""

    base: str
    zone: str
    domain: str
    schema_type: str
    phase: str

    def __str__(self) -> str:
        return "/".join([self.base.rstrip("/"), self.zone, self.domain, self.schema_type, self.phase])


def complete_snapshots(spark: SparkSession, root: str) -> list[str]:
    """Names of complete snapshots, oldest first."""
    return [n for n in files.child_directories(spark, root) if files.exists(spark, f"{root}/{n}/_SUCCESS")]


def resolve_snapshot(spark: SparkSession, root: str, pinned: str | None = None) -> str:
    """Path of the newest complete snapshot, or of the pinned one."""
    if pinned is not None:
        if not files.exists(spark, f"{root}/{pinned}/_SUCCESS"):
            raise FileNotFoundError(f"no complete snapshot {pinned} below {root}")
        return f"{root}/{pinned}"
    for name in reversed(files.child_directories(spark, root)):
        if files.exists(spark, f"{root}/{name}/_SUCCESS"):
            return f"{root}/{name}"
    raise FileNotFoundError(f"no complete snapshot below {root}")


def read_parquet(spark: SparkSession, root: str, pinned: str | None = None) -> DataFrame:
    return spark.read.parquet(resolve_snapshot(spark, root, pinned))


def read_json(
    spark: SparkSession,
    root: str,
    schema: T.StructType | str | None = None,
    pinned: str | None = None,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Read a JSON snapshot.  Without a schema the whole input is scanned once
    more to infer one; give the registered schema where there is one."""
    path = resolve_snapshot(spark, root, pinned)
    if schema is not None:
        return spark.read.options(**JSON_TIMES).schema(schema).json(path)
    return spark.read.option("samplingRatio", sampling_ratio).json(path)


def read_csv(spark: SparkSession, root: str, schema: T.StructType | str, pinned: str | None = None) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(resolve_snapshot(spark, root, pinned))


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str], rows_per_file: int | None):
    writer = df.write.mode(mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_parquet(
    df: DataFrame,
    root: str,
    snapshot: str | None = None,
    mode: str = "error",
    partition_by: Sequence[str] = (),
    rows_per_file: int | None = None,
) -> str:
    """Write one snapshot; the file count follows the plan, not a fixed number."""
    path = f"{root}/{snapshot or snapshot_now()}"
    _writer(df, mode, partition_by, rows_per_file).parquet(path)
    return path


def write_json(
    df: DataFrame,
    root: str,
    snapshot: str | None = None,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    rows_per_file: int | None = None,
) -> str:
    """Write one gzip JSON snapshot.

    A gzip file is read by one task.  Null fields are left out, so read it back
    with its schema.
    """
    path = f"{root}/{snapshot or snapshot_now()}"
    _writer(df, mode, partition_by, rows_per_file).options(compression="gzip", **JSON_TIMES).json(path)
    return path


def write_csv(df: DataFrame, root: str, snapshot: str | None = None, mode: str = "overwrite") -> str:
    path = f"{root}/{snapshot or snapshot_now()}"
    df.write.mode(mode).option("header", True).csv(path)
    return path


def mean_info(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per feature: its mean over non-null, non-NaN values."""
    means = df.agg(*[F.avg(F.when(~F.isnan(F.col(f).cast("double")), F.col(f))).alias(f) for f in fields])
    return means.select(
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("mean")) for f in fields])).alias("i")
    ).select("i.feature", "i.mean")


def retain_snapshots(spark: SparkSession, root: str, keep: int | None) -> list[str]:
    """Delete all but the newest ``keep`` complete snapshots; keep all if unset.

    Incomplete directories newer than the oldest kept snapshot are left alone,
    as a writer may still be busy.  Returns the names that remain complete.
    """
    names = complete_snapshots(spark, root)
    if not keep or len(names) <= keep:
        return names
    kept = names[-keep:]
    for name in files.child_directories(spark, root):
        if name < kept[0]:
            files.delete_child(spark, root, name)
    return kept


def snapshots_frame(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Snapshot names as a DataFrame, oldest first."""
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "position int, snapshot string")
