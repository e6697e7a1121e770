"""Sales reports over clean transactions, and the filterable sales dashboard.

``None`` for a selection means every value present (NULLs left out, as an
explicit list of all values would); an empty list selects nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.functions import numeric as num, temporal as t
from larder.operators.ranking import ascending, descending
from larder.operators.shares import share

SALE = "Sale"  # fixed value


def is_sale() -> Column:
    return F.col("transaction_type") == SALE


def chosen(column: str, values: Sequence[str] | None) -> Column:
    c = F.col(column)
    return c.isNotNull() if values is None else c.isin(list(values))


def _dated_sales(transactions: DataFrame) -> DataFrame:
    return transactions.filter(
        is_sale() & F.col("transaction_date").isNotNull() & F.col("amount").isNotNull()
    )


def _rounded_measures(average: str) -> list[Column]:
    return [
        F.count("*").alias("nb_transactions"),
        num.total(F.col("amount")).alias("total_sales"),
        num.mean(F.col("amount"), 2).alias(average),
    ]


# --- reports -----------------------------------------------------------------


def monthly_sales_mom(transactions: DataFrame) -> DataFrame:
    """Sales per month with growth on the month before."""
    monthly = (
        _dated_sales(transactions)
        .groupBy(t.month_of(F.col("transaction_date")).alias("month"))
        .agg(*_rounded_measures("avg_transaction_value"))
    )
    # one row per month reaches this window
    before = F.lag("total_sales").over(Window.orderBy("month"))
    growth = num.quotient((F.col("total_sales") - before) * 100, before, 2)
    return monthly.withColumn("growth_pct_mom", growth).orderBy("month")


def quarterly_sales(transactions: DataFrame) -> DataFrame:
    return (
        _dated_sales(transactions)
        .groupBy(t.quarter_of(F.col("transaction_date")).alias("quarter"))
        .agg(*_rounded_measures("avg_transaction_value"))
        .orderBy("quarter")
    )


def weekday_sales(transactions: DataFrame) -> DataFrame:
    return (
        _dated_sales(transactions)
        .groupBy(
            t.day_name(F.col("transaction_date")).alias("day_of_week"),
            t.day_number(F.col("transaction_date")).alias("day_num"),
        )
        .agg(*_rounded_measures("avg_transaction_value"))
        .orderBy("day_num")
    )


def region_sales_share(transactions: DataFrame) -> DataFrame:
    per_region = (
        transactions.filter(is_sale() & F.col("region").isNotNull() & F.col("amount").isNotNull())
        .groupBy("region")
        .agg(*_rounded_measures("avg_transaction"))
    )
    return per_region.withColumn("pct_total_sales", share(F.col("total_sales"))).orderBy(
        descending("total_sales"), ascending("region")
    )


# --- dashboard queries -------------------------------------------------------


def sales_regions(transactions: DataFrame) -> DataFrame:
    return _options(transactions, "region")


def sales_payment_methods(transactions: DataFrame) -> DataFrame:
    return _options(transactions, "payment_method")


def _options(transactions: DataFrame, column: str) -> DataFrame:
    return transactions.filter(is_sale() & F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def _selected_sales(transactions, regions, methods, min_amount) -> DataFrame:
    return transactions.filter(
        is_sale()
        & chosen("region", regions)
        & chosen("payment_method", methods)
        & (F.col("amount") >= F.lit(Decimal(str(min_amount))))
    )


def _measures() -> list[Column]:
    return [
        F.count("*").alias("nb_transactions"),
        num.total(F.col("amount")).alias("total_sales"),
        num.mean(F.col("amount"), 8).alias("avg_transaction_value"),
    ]


def filtered_monthly_sales(
    transactions: DataFrame,
    regions: Sequence[str] | None = None,
    methods: Sequence[str] | None = None,
    min_amount: float | int = 0,
) -> DataFrame:
    return (
        _selected_sales(transactions, regions, methods, min_amount)
        .groupBy(t.month_of(F.col("transaction_date")).alias("month"), "region")
        .agg(*_measures())
        .orderBy(ascending("month"), ascending("region"))
    )


def filtered_region_sales(
    transactions: DataFrame,
    regions: Sequence[str] | None = None,
    methods: Sequence[str] | None = None,
    min_amount: float | int = 0,
) -> DataFrame:
    return (
        _selected_sales(transactions, regions, methods, min_amount)
        .groupBy("region")
        .agg(*_measures())
        .orderBy(descending("total_sales"), ascending("region"))
    )


def filtered_weekday_sales(
    transactions: DataFrame,
    regions: Sequence[str] | None = None,
    methods: Sequence[str] | None = None,
    min_amount: float | int = 0,
) -> DataFrame:
    return (
        _selected_sales(transactions, regions, methods, min_amount)
        .groupBy(
            t.day_name(F.col("transaction_date")).alias("day_of_week"),
            t.day_number(F.col("transaction_date")).alias("day_num"),
            "region",
        )
        .agg(*_measures())
        .orderBy(ascending("day_num"), ascending("region"))
    )


# --- figures derived from the dashboard queries ------------------------------


def sales_kpis(monthly: DataFrame) -> DataFrame:
    """One row: total sales, transactions and average ticket (0 when nothing was sold)."""
    tx = F.sum("nb_transactions")
    sales = F.sum("total_sales")
    return monthly.agg(
        F.coalesce(sales, F.lit(0)).cast("decimal(28,2)").alias("total_sales"),
        F.coalesce(tx, F.lit(0)).alias("total_transactions"),
        F.when(tx > 0, num.ratio_double(sales, tx)).otherwise(0.0).alias("avg_ticket"),
    )


def best_month(monthly: DataFrame) -> DataFrame:
    """Month with the highest total over the selected regions; the earliest on a tie."""
    return (
        monthly.filter("month IS NOT NULL")
        .groupBy("month")
        .agg(num.total(F.col("total_sales")).alias("total_sales"))
        .orderBy(F.col("total_sales").desc_nulls_last(), "month")
        .limit(1)
    )


def _all_regions(df: DataFrame, *by: str) -> DataFrame:
    """Second-level roll-up. The average is the plain mean of the regions' averages."""
    return df.dropna(subset=list(by)).groupBy(*by).agg(
        num.total(F.col("total_sales")).alias("total_sales"),
        F.sum("nb_transactions").alias("nb_transactions"),
        num.ratio_double(F.sum("avg_transaction_value"), F.count("avg_transaction_value")).alias(
            "avg_transaction_value"
        ),
    )


def monthly_rollup_all_regions(monthly: DataFrame) -> DataFrame:
    return _all_regions(monthly, "month").orderBy("month")


def monthly_for_region(monthly: DataFrame, region: str) -> DataFrame:
    return monthly.filter(F.col("region") == region)


def weekday_rollup_all_regions(weekdays: DataFrame) -> DataFrame:
    return _all_regions(weekdays, "day_of_week", "day_num").orderBy("day_num")


def weekday_for_region(weekdays: DataFrame, region: str) -> DataFrame:
    return weekdays.filter(F.col("region") == region).orderBy(ascending("day_num"))


def monthly_detail(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy(ascending("month"), F.col("total_sales").desc_nulls_last(), ascending("region"))


def weekday_detail(weekdays: DataFrame) -> DataFrame:
    return weekdays.orderBy(ascending("day_num"), F.col("total_sales").desc_nulls_last(), ascending("region"))


def top_regions(per_region: DataFrame, limit: int = 3) -> DataFrame:
    """First ``limit`` regions on each of the three measures, in one frame.

    Ties go to the region listed first by total sales.
    """
    measures = ["total_sales", "nb_transactions", "avg_transaction_value"]
    return ranked_by_each(per_region, "region", measures, limit, tie="total_sales")


def ranked_by_each(df: DataFrame, label: str, measures: list[str], limit: int, tie: str) -> DataFrame:
    """First ``limit`` labels on each measure, one row per measure and position.

    For report results with one row per label. Equal values follow ``tie``,
    largest first, then the label.
    """
    values = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("decimal(28,8)").alias("value")) for m in measures
    ]
    long = df.select(label, F.col(tie).alias("_tie"), F.inline(F.array(*values)))
    order = Window.partitionBy("metric").orderBy(
        F.col("value").desc_nulls_last(), F.col("_tie").desc_nulls_last(), F.col(label)
    )
    return (
        long.withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= limit)
        .select("metric", "position", label, "value")
        .orderBy("metric", "position")
    )


def sales_filter_summary(
    transactions: DataFrame,
    regions: Sequence[str] | None = None,
    methods: Sequence[str] | None = None,
    min_amount: float | int = 0,
) -> DataFrame:
    """One row with the number of values each filter lets through."""
    return transactions.filter(is_sale()).agg(
        selected_count("region", regions).alias("nb_regions"),
        selected_count("payment_method", methods).alias("nb_payment_methods"),
        F.lit(Decimal(str(min_amount))).cast("decimal(18,2)").alias("min_amount"),
    )


def selected_count(column: str, values: Sequence[str] | None) -> Column:
    return F.count_distinct(column) if values is None else F.lit(len(values)).cast("bigint")
