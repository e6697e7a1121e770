"""Column rules used by the cleaning layer."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def blank_to_null(c: Column, strict: bool = False) -> Column:
    """Empty text becomes NULL, then outer spaces go.

    The NULL test comes first, so text made only of spaces ends as ``''``.
    ``strict=True`` turns that into NULL too.
    """
    if strict:
        return F.nullif(F.trim(c), F.lit(""))
    return F.trim(F.nullif(c, F.lit("")))


def trim_only(c: Column) -> Column:
    return F.trim(c)


def normalize_email(c: Column) -> Column:
    return F.lower(blank_to_null(c))


def non_negative(c: Column) -> Column:
    return F.when(c < 0, None).otherwise(c)


def in_range(c: Column, low: int, high: int) -> Column:
    return F.when(c.between(low, high), c)


def fix_end(start: Column, end: Column) -> Column:
    """An end before its start is unknown, so NULL; a NULL on either side leaves the end alone."""
    return F.when(start > end, None).otherwise(end)
