"""Column builders for text that several operators share; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_url(c: str | Column) -> Column:
    """The address before its first ``?`` or ``#``; null stays null."""
    return F.substring_index(F.substring_index(col_of(c), "?", 1), "#", 1)


def collapse_space(c: str | Column) -> Column:
    """Each run of white space, no-break spaces included, as one space; none at the ends."""
    return F.trim(F.regexp_replace(col_of(c), r"(?U)\s+", " "))


def compared_value(c: str | Column) -> Column:
    """A value as values are compared: lower case, white space collapsed; blank becomes null."""
    v = F.lower(collapse_space(c))
    return F.when(v != "", v)


def compared_values(*arrays: str | Column) -> Column:
    """All values of several string arrays, as compared, with repeats; null and blank ones are dropped.

    A null array counts as an empty one, so the result is never null.
    """
    empty = F.array().cast("array<string>")
    parts = [F.coalesce(col_of(a), empty) for a in arrays]
    return F.filter(F.transform(F.concat(*parts), compared_value), lambda v: v.isNotNull())


def value_set(*arrays: str | Column) -> Column:
    """The distinct values of several string arrays together, as compared, in sorted order."""
    return F.array_sort(F.array_distinct(compared_values(*arrays)))


def digits_only(c: str | Column) -> Column:
    return F.regexp_replace(col_of(c), "[^0-9]", "")


def null_marked(*cols: str | Column) -> list[Column]:
    """Each column with its null flag before it: hash functions skip nulls, the flags keep them apart."""
    out: list[Column] = []
    for c in map(col_of, cols):
        out += [c.isNull(), c]
    return out


def finite(c: str | Column) -> Column:
    """NaN as null."""
    c = col_of(c)
    return F.when(~F.isnan(c), c)
