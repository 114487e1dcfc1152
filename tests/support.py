"""Helpers that several test modules import; not a conftest, of which there is one in each folder."""

from __future__ import annotations


def rows(df, *order):
    """Collected rows as tuples in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
