"""Share of a total over rows that are already aggregated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.functions.numeric import quotient


def share(value: Column, *within: str) -> Column:
    """Percentage of ``value`` in its group, or in all rows when no group is named.

    Use only after a groupBy: the window then holds one row per dimension value,
    not one per fact.
    """
    whole = F.sum(value).over(Window.partitionBy(*within))
    return quotient(value.cast("decimal(28,2)") * 100, whole, 2)


def with_overall_share(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add a share of the grand total when the number of rows may be large.

    The total is a one-row scalar subquery, so the rows stay spread out instead
    of meeting in one window task.
    """
    grand = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, quotient(F.col(value).cast("decimal(28,2)") * 100, grand, 2))
