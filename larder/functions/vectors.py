"""Array-of-number columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pair_mean(x: Column | str, y: Column | str) -> Column:
    """Element-wise mean of two vectors; ``x`` where ``y`` is null."""
    x, y = _column(x), _column(y)
    mean = F.zip_with(x, y, lambda a, b: (a.cast("double") + b.cast("double")) / 2)
    return F.coalesce(mean, F.transform(x, lambda a: a.cast("double")))


def dot(x: Column | str, y: Column | str) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(_column(x), _column(y), lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def vector_text(v: Column | str, digits: int = 5) -> Column:
    """The vector as text with fixed decimals, for reports and comparisons."""
    return F.array_join(F.transform(_column(v), lambda e: F.format_string(f"%.{digits}f", e.cast("double"))), ",")


def tokens(text: Column | str) -> Column:
    """The runs of a text without white space; none where it is null."""
    return F.regexp_extract_all(F.coalesce(_column(text), F.lit("")), F.lit("[^ \t\n\r\f\x0b]+"), F.lit(0))


def token_place(token: Column | str, dim: int) -> Column:
    """The place of a token in a vector of ``dim`` elements, by md5; null for no token."""
    head = F.substring(F.md5(_column(token).cast("binary")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(dim)).cast("int")


def densified(entries: Column | str, dim: int, kind: str) -> Column:
    """A vector from an array of structs (place, value), each place at most once; places that are not there are 0."""
    found = F.map_from_entries(_column(entries))
    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda b: F.coalesce(F.try_element_at(found, b), F.lit(0.0)).cast(kind))
