"""Numeric helpers that stay defined under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text to double; text that is not a number becomes null."""
    return _column(c).try_cast("double")


def null_normalize(c: Column | str) -> Column:
    """NaN to null for a floating-point column."""
    c = _column(c)
    return F.when(~F.isnan(c), c)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, null where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def f1(precision: Column, recall: Column) -> Column:
    """Harmonic mean of precision and recall; null where either is 0 or null."""
    inverse = F.try_divide(F.lit(1.0), precision) + F.try_divide(F.lit(1.0), recall)
    return F.try_divide(F.lit(2.0), inverse)


def grid_point(low: Column, high: Column, k: Column, points: int = 100) -> Column:
    """Point ``k`` (from 0) of ``points`` evenly spaced values from low to high."""
    return low + (high - low) * k / F.lit(float(points - 1))


def earliest(*columns: Column | str) -> Column:
    """The smallest non-null value of a row."""
    return F.least(*[_column(c) for c in columns])
