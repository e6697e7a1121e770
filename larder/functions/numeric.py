"""Exact decimal aggregates.

Averages and rates are formed as decimal sum / count, so that rounding is half
away from zero on the true quotient: rounding a binary double gives a different
cent whenever the quotient is a tie.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# every rounded figure leaves as decimal(28, scale)
_DIGITS = 28


def fixed(c: Column, scale: int) -> Column:
    return F.round(c, scale).cast(f"decimal({_DIGITS},{scale})")


def total(c: Column) -> Column:
    """Sum of a money column as decimal(28,2)."""
    return F.sum(c).cast(f"decimal({_DIGITS},2)")


def quotient(num: Column, den: Column, scale: int) -> Column:
    """``num / den`` rounded once to ``scale``; NULL when the divisor is zero.

    ``num`` is a decimal with at most four decimals (an integer pair would
    divide as doubles), ``den`` a whole number or a decimal with two. Spark
    gives a quotient fewer digits the wider its operands are, and with few
    digits a value just below a tie becomes one. So operands of up to twenty
    whole digits are narrowed first, for sixteen digits after the point; wider
    ones divide as they are.
    """
    narrow = num.try_cast("decimal(24,4)") / F.nullif(den.try_cast("decimal(22,2)"), F.lit(0))
    wide = num / F.nullif(den, F.lit(0))
    return F.coalesce(fixed(narrow, scale), fixed(wide, scale))


def mean(c: Column, scale: int) -> Column:
    """Average of a decimal column, NULLs skipped."""
    return quotient(F.sum(c), F.count(c), scale)


def mean_int(c: Column, scale: int) -> Column:
    """Average of a whole-number column, NULLs skipped."""
    return quotient(F.sum(c).cast("decimal(20,0)"), F.count(c), scale)


def mean_pct(c: Column, scale: int) -> Column:
    """Average of a ratio column, as a percentage."""
    return quotient(F.sum(c) * 100, F.count(c), scale)


def percent(num: Column, den: Column, scale: int = 2) -> Column:
    """Share of two counts, as a percentage."""
    return quotient(num.cast("decimal(20,0)") * 100, den, scale)


def count_if(condition: Column) -> Column:
    """Number of rows where the condition holds; NULL counts as no."""
    return F.sum(F.when(condition, 1).otherwise(0))


def ratio_double(num: Column, den: Column) -> Column:
    """Division in double precision, NULL when the divisor is zero."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation of two whole-number columns, rows with a NULL skipped; NULL where one does not vary.

    Sums of values and products are exact decimals, so the result does not
    depend on the order or partitioning of the rows; where products of sums pass
    38 digits the last step goes on in doubles.
    """
    both = x.isNotNull() & y.isNotNull()
    x, y = (F.when(both, c.cast("decimal(20,0)")) for c in (x, y))
    n = F.count(x).cast("decimal(20,0)")

    def spread(a: Column, b: Column) -> Column:
        ab, sa, sb = (F.try_sum(c).cast("decimal(38,0)") for c in (a * b, a, b))
        exact = F.try_subtract(F.try_multiply(n, ab), F.try_multiply(sa, sb)).cast("double")
        return F.coalesce(exact, n.cast("double") * ab.cast("double") - sa.cast("double") * sb.cast("double"))

    return spread(x, y) / F.nullif(F.sqrt(spread(x, x)) * F.sqrt(spread(y, y)), F.lit(0.0))
