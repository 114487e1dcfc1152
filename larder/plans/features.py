"""Feature plug-ins and the features that ship with the package.

A general feature maps a dataset to the dataset with more columns.  A periodic
one maps rows that carry their window, and also takes the windows.  A registry
finds both by name.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import text
from larder.operators import aggregates, filters, joins
from larder.plans.windows import Windows, attach_window_features, window_features


class FeatureNotFound(KeyError):
    """No feature of that name and kind is registered."""


@dataclass(frozen=True)
class GeneralFeature:
    name: str
    fields: Sequence[str]
    apply: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class PeriodicFeature:
    name: str
    fields: Sequence[str]
    apply: Callable[[DataFrame, Windows], DataFrame]


@dataclass
class FeatureRegistry:
    _general: dict[str, GeneralFeature] = field(default_factory=dict)
    _periodic: dict[str, PeriodicFeature] = field(default_factory=dict)

    def register(self, feature: GeneralFeature | PeriodicFeature) -> FeatureRegistry:
        known = self._periodic if isinstance(feature, PeriodicFeature) else self._general
        known[feature.name] = feature
        return self

    def general(self, name: str) -> GeneralFeature:
        return self._find(self._general, name)

    def periodic(self, name: str) -> PeriodicFeature:
        return self._find(self._periodic, name)

    @staticmethod
    def _find(known: dict, name: str):
        if name not in known:
            raise FeatureNotFound(name)
        return known[name]

    def apply_general(self, df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list[str]]:
        """Apply general features in order; returns the added field names too."""
        added: list[str] = []
        for name in names:
            feature = self.general(name)
            df = feature.apply(df)
            added += feature.fields
        return df, added

    def apply_periodic(self, df: DataFrame, names: Sequence[str], windows: Windows) -> tuple[DataFrame, list[str]]:
        """Apply periodic features in order; returns the added field names too."""
        added: list[str] = []
        for name in names:
            feature = self.periodic(name)
            df = feature.apply(df, windows)
            added += feature.fields
        return df, added


# --- positive ratio -------------------------------------------------------


def positive_ratio_feature(
    table: DataFrame, key: str, name: str = "positive_ratio", mean: float | None = None
) -> GeneralFeature:
    """Share of positive feedback per key; a missing key gets the mean, which
    may be the one stored beside the feature."""
    return GeneralFeature(name, [name], lambda df: joins.fill_with_mean(df, table, key, name, mean))


# --- badges ---------------------------------------------------------------


#: Badges that may become columns; more are a long table.
MOST_BADGES = 1000


def badge_names(df: DataFrame, badges: str, at_most: int = MOST_BADGES) -> list[str]:
    """Sorted distinct badges, to become columns.  More than ``at_most`` are an error, never a cut: ``badge_rows`` holds
    any number."""
    names = [r[0] for r in aggregates.distinct_categories(df, badges).take(at_most + 1)]
    if len(names) > at_most:
        raise ValueError(f"more than {at_most} distinct badges in {badges}: use badge_rows")
    return sorted(names)


def badge_rows(df: DataFrame, key: str, badges: str) -> DataFrame:
    """(key, badge) for every badge of a key: the flags as a long table, however many badges there are."""
    return df.select(key, F.explode(text.split_badges(badges)).alias("badge")).filter("badge <> ''").distinct()


def badge_flags(df: DataFrame, key: str, badges: str, names: Sequence[str], mode: str = "token") -> DataFrame:
    """One 0/1 column per badge, all in one projection."""
    flags = [text.has_badge(badges, n, mode).alias(n) for n in names]
    return df.select(key, badges, *[F.coalesce(f, F.lit(0)).alias(n) for f, n in zip(flags, names)])


def badge_feature(table: DataFrame, key: str, names: Sequence[str], name: str = "item_badge_types") -> GeneralFeature:
    """Badge flags by key; a missing key keeps nulls."""
    flags = table.select(key, *names)
    return GeneralFeature(name, list(names), lambda df: joins.attach(df, flags, key))


# --- text length ----------------------------------------------------------


def text_length_table(df: DataFrame, key: str, column: str, out: str = "intro_len") -> DataFrame:
    """Length of a text per key; empty and missing texts are left out."""
    return filters.with_positive_length(df.select(key, column), column, out).select(key, out)


def text_length_feature(table: DataFrame, key: str, name: str = "intro_len") -> GeneralFeature:
    """Text length by key; a missing key gets 0."""
    return GeneralFeature(name, [name], lambda df: joins.fill_with_zero(df, table, key, [name]))


# --- periodic -------------------------------------------------------------


def windowed_feature(
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    time: str,
    fields: dict[str, Column],
    spread_by: Sequence[str] | None = None,
) -> PeriodicFeature:
    """Aggregates of ``source`` over the window before each row's own.

    With ``spread_by`` hot keys, counted on the source, are split over tasks.
    """
    columns = [c.alias(n) for n, c in fields.items()]

    def apply(df: DataFrame, windows: Windows) -> DataFrame:
        made = window_features(source, windows, keys, time, columns)
        heat = windows.targets(source.select(*keys, time), time)
        return attach_window_features(df, made, windows, keys, spread_by, heat)

    return PeriodicFeature(name, list(fields), apply)
