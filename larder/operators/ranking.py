"""Ordering and top-k with NULL as the largest value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def ascending(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def descending(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def top(df: DataFrame, limit: int | None, *order: Column) -> DataFrame:
    """Ordered rows, cut to ``limit`` (``None`` keeps all). Plans as TakeOrderedAndProject."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)
