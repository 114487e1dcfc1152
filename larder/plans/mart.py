"""Training-set assembly: one plan for all phases."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import sampling
from larder.plans.features import FeatureRegistry
from larder.plans.windows import ORDINAL, PHASE, PeriodWindows, PhaseWindows
from larder.sources import schemas, snapshots


@dataclass(frozen=True)
class MartSpec:
    """Columns and features of a mart dataset."""

    keys: Sequence[str]
    sample_keys: Sequence[str]
    label: str = "label"
    time: str = "logged_at"
    extras: Sequence[str] = ()
    periodic: Sequence[str] = ()
    general: Sequence[str] = ()
    period_days: int = 7
    gap_days: int = 0
    sample_seed: int = 7


@dataclass(frozen=True)
class Phase:
    """A phase, its interval, and the share of its rows that is kept."""

    name: str
    start: datetime
    end: datetime
    fraction: float = 1.0


# Fixed value: the share of the test phase that is kept.
TEST_FRACTION = 0.333


def mart_dataset(
    labeled: DataFrame, registry: FeatureRegistry, spec: MartSpec, phases: Sequence[Phase]
) -> DataFrame:
    """Rows of all phases with periodic and general features and their phase.

    Phases and windows are columns, so every table is scanned and joined once,
    however many there are.  The time filter comes first and reaches the scan.
    General features depend on keys the rows already carry, so they are attached
    in place; no second copy of the dataset is joined back.  Sampling looks only
    at the key and comes before the joins, which keeps the same rows.
    """
    windows = PhaseWindows({p.name: PeriodWindows(p.start, p.end, spec.period_days, spec.gap_days) for p in phases})
    rows = windows.targets(labeled, spec.time)
    for phase in phases:
        if phase.fraction < 1.0:
            sampled = sampling.in_sample(spec.sample_keys, phase.fraction, spec.sample_seed)
            rows = rows.filter((F.col(PHASE) != phase.name) | sampled)
    rows, _ = registry.apply_periodic(rows, spec.periodic, windows)
    rows, _ = registry.apply_general(rows, spec.general)
    return rows.drop(*spec.extras, ORDINAL)


def mart_features(dataset: DataFrame, spec: MartSpec) -> list[str]:
    return schemas.feature_names(dataset.columns, [*spec.keys, spec.time, PHASE], spec.label, spec.extras)


def write_mart(dataset: DataFrame, root: str, snapshot: str | None = None) -> str:
    """Write one snapshot with a directory per phase, in a single pass."""
    return snapshots.write_parquet(dataset, root, snapshot, partition_by=[PHASE])


def read_mart(spark: SparkSession, root: str, phase: str, pinned: str | None = None) -> DataFrame:
    """The rows of one phase of the latest (or pinned) mart snapshot."""
    return snapshots.read_parquet(spark, root, pinned).filter(F.col(PHASE) == phase).drop(PHASE)
