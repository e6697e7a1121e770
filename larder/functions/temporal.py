"""Date helpers. All results are DATE or whole numbers, never timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The reference day of a report: a fixed day if given, else today."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def month_of(c: Column) -> Column:
    return F.trunc(c, "month")


def quarter_of(c: Column) -> Column:
    return F.trunc(c, "quarter")


def day_name(c: Column) -> Column:
    """Mon .. Sun."""
    return F.dayname(c)


def day_number(c: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(c) - 1


def iso_day_number(c: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(c) + 1


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def year_boundaries(start: Column, end: Column) -> Column:
    """Calendar years crossed, not birthdays passed: 2000-12-31 to 2024-01-01 is 24."""
    return F.year(end) - F.year(start)
