"""Labelled value bands.

Two families exist on purpose. *Closed* bands test ``low <= x <= high`` with
whole-number edges, so a value between two bands (9.5 minutes, a 19.5 %
discount) falls through to the last label. *Half-open* bands have no gaps.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F

# Labels and edges appear in results.
INCOME_GROUPS = {
    "first": ("< 30K", 30000),
    "closed": (("30K-50K", 30000, 49999), ("50K-75K", 50000, 74999), ("75K-100K", 75000, 99999)),
    "last": "100K+",
}
DISCOUNT_GROUPS = {
    "first": ("< 10%", Decimal("0.10")),
    "closed": (
        ("10-19%", Decimal("0.10"), Decimal("0.19")),
        ("20-29%", Decimal("0.20"), Decimal("0.29")),
        ("30-39%", Decimal("0.30"), Decimal("0.39")),
    ),
    "last": "40%+",
}
DURATION_GROUPS = {
    "first": ("< 5 min", 5),
    "closed": (("5-9 min", 5, 9), ("10-19 min", 10, 19), ("20-29 min", 20, 29)),
    "last": "30+ min",
}
AGE_GROUPS = {
    "below": (("18-24", 25), ("25-34", 35), ("35-44", 45), ("45-54", 55), ("55-64", 65)),
    "last": "65+",
}
DISCOUNT_STEPS = {
    "below": (
        ("< 10%", Decimal("0.10")), ("10-19%", Decimal("0.20")),
        ("20-29%", Decimal("0.30")), ("30-39%", Decimal("0.40")),
    ),
    "last": "40%+",
}
AGE_SEGMENTS = {
    "below": (("18-24", 25), ("25-34", 35), ("35-44", 45), ("45-59", 60)),
    "last": "60+",
    "missing": "NA",
}
INCOME_SEGMENTS = {
    "below": (("<20k", 20000), ("20k-49k", 50000), ("50k-99k", 100000)),
    "last": "100k+",
    "missing": "NA",
}
RATING_CLASSES = {
    "at_least": (
        ("Excellent (4.5-5.0)", Decimal("4.5")), ("Très bon (4.0-4.4)", Decimal("4.0")),
        ("Bon (3.5-3.9)", Decimal("3.5")), ("Moyen (3.0-3.4)", Decimal("3.0")),
    ),
    "last": "Faible (< 3.0)",
}


def _first_match(tests: list[tuple[Column, str]], otherwise: str) -> Column:
    chain = reduce(lambda acc, t: acc.when(t[0], F.lit(t[1])), tests, F)
    return chain.otherwise(F.lit(otherwise))


def closed_band(c: Column, bands: dict) -> Column:
    label, edge = bands["first"]
    tests = [(c < F.lit(edge), label)]
    tests += [(c.between(F.lit(low), F.lit(high)), name) for name, low, high in bands["closed"]]
    return _first_match(tests, bands["last"])


def stepped_band(c: Column, bands: dict) -> Column:
    """Ascending half-open steps; NULL takes the ``missing`` label, or the last one if none."""
    tests = [(c.isNull(), bands["missing"])] if "missing" in bands else []
    tests += [(c < F.lit(edge), name) for name, edge in bands["below"]]
    return _first_match(tests, bands["last"])


def graded_band(c: Column, bands: dict) -> Column:
    """Descending steps: the first lower edge the value reaches."""
    tests = [(c >= F.lit(edge), name) for name, edge in bands["at_least"]]
    return _first_match(tests, bands["last"])


def band_rank(label: Column, bands: dict) -> Column:
    """Position of a closed-band label, for ordering output low to high."""
    names = [bands["first"][0], *(b[0] for b in bands["closed"]), bands["last"]]
    return F.array_position(F.array(*map(F.lit, names)), label)
