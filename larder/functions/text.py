"""Text columns: splitting, lengths, tokens, bitmaps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PIPE = "[|]"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_pipe(c: Column | str) -> Column:
    """``a|b`` to ``[a, b]``; null and empty text become null."""
    c = _column(c)
    return F.when(F.length(c) > 0, F.split(c, PIPE))


def split_badges(c: Column | str) -> Column:
    """``a|b`` to ``[a, b]``; null and empty text become an empty list."""
    return F.coalesce(split_pipe(c), F.array().cast("array<string>"))


def has_badge(c: Column | str, badge: str, mode: str = "token") -> Column:
    """0/1 flag for one badge of a pipe-joined text.

    ``token`` compares whole badges.  ``substring`` also accepts a badge that
    is part of a longer one.
    """
    c = _column(c)
    if mode == "token":
        hit = F.array_contains(split_badges(c), badge)
    elif mode == "substring":
        hit = F.coalesce(F.contains(c, F.lit(badge)), F.lit(False))
    else:
        raise ValueError(f"unknown badge mode {mode!r}")
    return hit.cast("int")


def text_length(c: Column | str) -> Column:
    """Number of characters, 0 for null."""
    return F.coalesce(F.length(_column(c)), F.lit(0))


def condense(c: Column | str) -> Column:
    """The text without any white space."""
    return F.regexp_replace(_column(c), r"\s", "")


def tokens(c: Column | str, pattern: str = r"[^\s]+") -> Column:
    """All matches of ``pattern`` in reading order; null stays null."""
    return F.regexp_extract_all(_column(c), F.lit(pattern), F.lit(0))


def with_tokens(df, fields, tokenizer: Callable[[Column], Column] = tokens, suffix: str = "_token"):
    """Add ``<field>_token`` for every field.  ``tokenizer`` maps a text column
    to an array column and may be a pandas UDF."""
    return df.withColumns({f"{f}{suffix}": tokenizer(F.col(f)) for f in fields})


def bit_ranges(bits: Column | str, slot_minutes: int = 60) -> Column:
    """Maximal runs of ``1`` in a bit string as half-open time ranges.

    Slot ``i`` covers the minutes ``[i * slot_minutes, (i + 1) * slot_minutes)``
    of a day.  A run becomes ``HH:mm-HH:mm``.  Null stays null; a text without
    any ``1`` gives an empty list.
    """
    bits = _column(bits)
    positions = F.sequence(F.lit(1), F.greatest(F.length(bits), F.lit(1)))

    def is_set(i: Column) -> Column:
        return F.substring(bits, i, F.lit(1)) == "1"

    starts = F.filter(positions, lambda i: is_set(i) & ((i == 1) | ~is_set(i - 1)))
    ends = F.filter(positions, lambda i: is_set(i) & ~is_set(i + 1))

    def clock(slots: Column) -> Column:
        minutes = slots * slot_minutes
        return F.format_string("%02d:%02d", (minutes / 60).cast("int"), (minutes % 60).cast("int"))

    ranges = F.zip_with(starts, ends, lambda s, e: F.concat(clock(s - 1), F.lit("-"), clock(e)))
    return F.when(bits.isNotNull(), ranges)
