"""Small literal frames in the shape of the raw tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from larder.schemas import TABLES


def _value(column, value):
    if value is None:
        return None
    if column.type == "date":
        return dt.date.fromisoformat(value) if isinstance(value, str) else value
    if column.type.startswith("decimal"):
        return Decimal(str(value))
    return value


def table(spark, name, *rows, **defaults):
    """Rows as dicts; columns left out are NULL or take the given default."""
    spec = TABLES[name]
    data = [
        tuple(_value(c, {**defaults, **row}.get(c.name)) for c in spec.columns) for row in rows
    ]
    return spark.createDataFrame(data, spec.schema)


def sales(spark, *rows, **defaults):
    return table(
        spark, "financial_transactions",
        *[{"transaction_id": f"t{i}", **r} for i, r in enumerate(rows)],
        **{"transaction_type": "Sale", "region": "N", "transaction_date": "2024-01-10", **defaults},
    )


def rows(df):
    return [tuple(r) for r in df.collect()]
