"""Row-level interval joins: what the join-free sums of the engine are checked against."""

from pyspark.sql import DataFrame, functions as F

from larder.operators.intervals import _usable
from larder.plans.promotions import WITH_PROMOTION, WITHOUT_PROMOTION
from larder.plans.sales import is_sale


def left_interval_join(
    facts: DataFrame,
    intervals: DataFrame,
    key: str,
    date: str,
    start: str,
    end: str,
) -> DataFrame:
    """Every fact with every interval covering it; facts without one keep NULLs.

    Intervals are repeated once per calendar month they touch and both sides
    meet on (key, month), so the work splits far beyond the number of keys. A
    fact lies in exactly one month, so no match is found twice. Months outside
    the facts' own range are never produced, which bounds open-ended intervals.
    Interval columns that share a name with a fact column are dropped, except
    that they still take part in the match.
    """
    first = facts.agg(F.min(date)).scalar()
    last = facts.agg(F.max(date)).scalar()
    months = F.sequence(
        F.trunc(F.greatest(F.col(start), first), "month"),
        F.trunc(F.least(F.col(end), last), "month"),
        F.expr("interval 1 month"),
    )
    reach = (F.col(end) >= first) & (F.col(start) <= last)
    taken = set(facts.columns)
    kept = [c for c in intervals.columns if c not in taken]
    spread = (
        _usable(intervals, key, start, end)
        .filter(reach)
        .select(
            F.col(key).alias("_key"),
            F.col(start).alias("_start"),
            F.col(end).alias("_end"),
            *kept,
            F.explode(months).alias("_month"),
        )
    )
    match = (
        (F.col(key) == F.col("_key"))
        & (F.trunc(F.col(date), "month") == F.col("_month"))
        & F.col(date).between(F.col("_start"), F.col("_end"))
    )
    return facts.join(spread, match, "left").drop("_key", "_start", "_end", "_month")


def sales_promotion_overlap(transactions: DataFrame, promotions: DataFrame) -> DataFrame:
    """Each sale with each promotion running that day."""
    sales = transactions.filter(is_sale() & F.col("amount").isNotNull()).select(
        "transaction_id", "transaction_date", "amount", "region"
    )
    joined = left_interval_join(
        sales,
        promotions.select(
            "promotion_id", "product_category", "discount_percentage", "start_date", "end_date", "region"
        ),
        "region", "transaction_date", "start_date", "end_date",
    )
    return joined.select(
        "transaction_id", "transaction_date", "amount", "region",
        "promotion_id", "product_category", "discount_percentage",
        F.when(F.col("promotion_id").isNotNull(), WITH_PROMOTION)
        .otherwise(WITHOUT_PROMOTION)
        .alias("promo_status"),
    )
