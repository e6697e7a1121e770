"""Vectors as whole numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# a component times this, rounded down, is its whole number
SCALE = 64


def whole_vectors(rows: DataFrame, vector: str = "embedding", scale: int = SCALE, add: int = 0) -> DataFrame:
    """(vec_id, x): each vector's components as ``floor(scale * c) + add``, c as double.

    Rows whose vector is null, or holds a component that is null, not finite or
    too large for a bigint, are left out. An empty vector stays.
    """
    c = f"transform(`{vector}`, c -> cast(c AS double) * {scale})"
    usable = "forall(y, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < 9.0e18D)"
    taken = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.expr(c).alias("y")).where("y IS NOT NULL").where(usable)
    return taken.select("vec_id", F.expr(f"transform(y, c -> floor(c) + {add}L)").alias("x"))
