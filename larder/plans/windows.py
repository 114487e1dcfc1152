"""Period windows and the point-in-time join.

A target row in window ``[start, end)`` may only see features computed on the
window of the same length that ends ``gap_days`` before ``start``.  Windows tile
the time axis, so a row's window is an integer division of its time offset, and
the join over all windows is one equi-join on (key, window number).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import joins

ORDINAL = "window_no"
PHASE = "phase"


@dataclass(frozen=True)
class PeriodWindows:
    """Windows of ``period_days`` from ``start``; the last one is cut at ``end``."""

    start: datetime
    end: datetime
    period_days: int
    gap_days: int = 0

    def __post_init__(self) -> None:
        if self.period_days < 1 or self.gap_days < 0 or self.end <= self.start:
            raise ValueError("windows need start < end, a positive period and no negative gap")

    @property
    def source_start(self) -> datetime:
        """Start of the feature window of the first target window."""
        return self.start - timedelta(days=self.period_days + self.gap_days)

    @property
    def source_end(self) -> datetime:
        """End of the feature window of the last target window."""
        return self.source_start + timedelta(days=self.period_days * self.count)

    @property
    def count(self) -> int:
        return -(-(self.end - self.start) // timedelta(days=self.period_days))

    def frame(self, spark: SparkSession) -> DataFrame:
        """(window_no, prev_start, prev_end, start, end), one row per window."""
        day = F.make_dt_interval(F.lit(1))

        def at(origin: datetime, days: Column) -> Column:
            return F.lit(origin).cast("timestamp_ntz") + day * days

        n = F.col(ORDINAL)
        start = at(self.start, n * self.period_days)
        end = F.least(at(self.start, (n + 1) * self.period_days), F.lit(self.end).cast("timestamp_ntz"))
        previous = at(self.source_start, n * self.period_days)
        return spark.range(1).select(
            F.explode(F.sequence(F.lit(0), F.lit(self.count - 1))).alias(ORDINAL)
        ).select(
            ORDINAL,
            previous.alias("prev_start"),
            (previous + day * self.period_days).alias("prev_end"),
            start.alias("start"),
            end.alias("end"),
        )

    @property
    def keys(self) -> list[str]:
        return [ORDINAL]

    def maximal(self) -> tuple[datetime, datetime]:
        """The interval covered by all target windows."""
        return self.start, self.end

    def _number(self, time: Column, origin: datetime, kind) -> Column:
        offset = time - F.lit(origin).cast(kind)
        return F.floor(F.extract(F.lit("DAY"), offset) / self.period_days).cast("int")

    def target_place(self, time: Column, kind) -> tuple[Column, Column]:
        """Whether a target row lies in a window, and the number of that window."""
        return _inside(time, self.start, self.end, kind), self._number(time, self.start, kind)

    def source_place(self, time: Column, kind) -> tuple[Column, Column]:
        """Whether a source row feeds a window, and the number of that window."""
        inside = _inside(time, self.source_start, self.source_end, kind)
        return inside, self._number(time, self.source_start, kind)

    def targets(self, df: DataFrame, time: str) -> DataFrame:
        """Rows inside the windows, with their window number."""
        inside, number = self.target_place(F.col(time), df.schema[time].dataType)
        return df.filter(inside).withColumn(ORDINAL, number)

    def sources(self, df: DataFrame, time: str) -> DataFrame:
        """Rows that feed some window, numbered by the window they feed."""
        inside, number = self.source_place(F.col(time), df.schema[time].dataType)
        return df.filter(inside).withColumn(ORDINAL, number)


def _inside(time: Column, start: datetime, end: datetime, kind) -> Column:
    return (time >= F.lit(start).cast(kind)) & (time < F.lit(end).cast(kind))


@dataclass(frozen=True)
class PhaseWindows:
    """The windows of several phases, placed in one pass over the rows.

    A row that lies in (or feeds) several phases appears once for each.
    """

    phases: Mapping[str, PeriodWindows]

    @property
    def keys(self) -> list[str]:
        return [PHASE, ORDINAL]

    def _placed(self, df: DataFrame, places: Mapping[str, tuple[Column, Column]]) -> DataFrame:
        any_phase = reduce(lambda a, b: a | b, [inside for inside, _ in places.values()])
        found = [
            F.when(inside, F.struct(F.lit(name).alias(PHASE), number.alias(ORDINAL)))
            for name, (inside, number) in places.items()
        ]
        rows = df.filter(any_phase).withColumn("__place", F.explode(F.array_compact(F.array(*found))))
        return rows.select(*df.columns, f"__place.{PHASE}", f"__place.{ORDINAL}")

    def targets(self, df: DataFrame, time: str) -> DataFrame:
        kind = df.schema[time].dataType
        return self._placed(df, {n: w.target_place(F.col(time), kind) for n, w in self.phases.items()})

    def sources(self, df: DataFrame, time: str) -> DataFrame:
        kind = df.schema[time].dataType
        return self._placed(df, {n: w.source_place(F.col(time), kind) for n, w in self.phases.items()})


Windows = PeriodWindows | PhaseWindows


def window_features(
    source: DataFrame, windows: Windows, keys: Sequence[str], time: str, features: Sequence[Column]
) -> DataFrame:
    """Features per key and target window, computed on the window before it.

    This is also the offline feature table: every value for every period.
    """
    return windows.sources(source, time).groupBy(*keys, *windows.keys).agg(*features)


def attach_window_features(
    rows: DataFrame,
    made: DataFrame,
    windows: Windows,
    keys: Sequence[str],
    spread_by: Sequence[str] | None = None,
    heat: DataFrame | None = None,
) -> DataFrame:
    """Join window features to rows that carry their window.

    With ``spread_by`` keys that hold many rows are split over tasks; ``heat``
    holds the rows to count them on, with their window.
    """
    on = [*keys, *windows.keys]
    if spread_by is None:
        return joins.attach(rows, made, on)
    return joins.join_salting_hot_keys(rows, made, on, spread_by, joins.default_parts(rows), heat)


def pit_join(
    target: DataFrame,
    source: DataFrame,
    windows: Windows,
    keys: Sequence[str],
    target_time: str,
    source_time: str,
    features: Sequence[Column],
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Attach to each target row the features of the window before its own.

    Rows outside the windows are dropped, others keep their count.
    """
    made = window_features(source, windows, keys, source_time, features)
    return attach_window_features(windows.targets(target, target_time), made, windows, keys, spread_by)
