"""Campaign reports and the marketing dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.functions import numeric as num
from larder.operators.intervals import totals_within
from larder.operators.ranking import ascending, descending, top
from larder.plans.sales import is_sale

LOW_ROI = 1  # fixed value: campaigns below it raise the alert


def _campaign_sales(campaigns: DataFrame, transactions: DataFrame, group: list[str]) -> DataFrame:
    """Sales in each campaign's region and period; a sale in several campaigns counts for each."""
    amount = F.col("amount")
    totals = totals_within(
        transactions.filter(is_sale()), campaigns,
        "region", "transaction_date", "start_date", "end_date",
        {
            "sales": F.when(F.col("transaction_id").isNotNull(), 1).otherwise(0),
            "revenue": amount,
            "revenues": F.when(amount.isNotNull(), 1).otherwise(0),
        },
        group,
    )
    revenue = F.when(F.col("revenues") > 0, F.col("revenue").cast("decimal(28,2)"))
    return totals.select(*group, F.col("sales").cast("bigint").alias("sales"), revenue.alias("revenue"))


_IDENTITY = ["campaign_id", "campaign_name", "campaign_type", "region", "budget", "reach", "conversion_rate"]


def campaign_roi(campaigns: DataFrame, transactions: DataFrame, limit: int | None = 20) -> DataFrame:
    """Campaigns by sales per unit of budget, best first."""
    running = campaigns.filter("campaign_id IS NOT NULL AND budget > 0")
    sales = _campaign_sales(running, transactions, [*_IDENTITY, "start_date", "end_date"])
    report = sales.select(
        "campaign_id", "campaign_name", "campaign_type", "region", "budget", "reach",
        num.fixed(F.col("conversion_rate") * 100, 2).alias("conversion_rate_pct"),
        F.col("sales").alias("nb_sales_in_period"),
        F.col("revenue").alias("total_sales_in_period"),
        num.quotient(F.col("revenue"), F.col("budget"), 2).alias("roi_ratio"),
        num.quotient(F.col("revenue"), F.col("reach"), 4).alias("revenue_per_reach"),
    )
    return top(report, limit, F.col("roi_ratio").desc_nulls_last(), ascending("campaign_id"))


def campaign_type_performance(campaigns: DataFrame) -> DataFrame:
    return (
        campaigns.filter("campaign_type IS NOT NULL AND budget > 0")
        .groupBy("campaign_type")
        .agg(
            F.count("*").alias("nb_campaigns"),
            num.total(F.col("budget")).alias("total_budget"),
            num.mean(F.col("budget"), 2).alias("avg_budget"),
            num.mean_pct(F.col("conversion_rate"), 2).alias("avg_conversion_pct"),
            num.mean_int(F.col("reach"), 0).alias("avg_reach"),
        )
        .orderBy(descending("avg_conversion_pct"), ascending("campaign_type"))
    )


def audience_performance(campaigns: DataFrame, limit: int | None = 15) -> DataFrame:
    report = (
        campaigns.filter("target_audience IS NOT NULL AND conversion_rate IS NOT NULL")
        .groupBy("target_audience")
        .agg(
            F.count("*").alias("nb_campaigns"),
            num.mean_pct(F.col("conversion_rate"), 2).alias("avg_conversion_pct"),
            num.total(F.col("budget")).alias("total_budget"),
            num.mean_int(F.col("reach"), 0).alias("avg_reach"),
        )
    )
    return top(report, limit, descending("avg_conversion_pct"), ascending("target_audience"))


# --- dashboard ---------------------------------------------------------------


def campaign_dashboard(campaigns: DataFrame, transactions: DataFrame, limit: int | None = None) -> DataFrame:
    """Unrounded return per campaign; periods of one campaign add up. ``limit`` is for a listing."""
    sales = _campaign_sales(campaigns.filter("budget > 0"), transactions, _IDENTITY)
    report = sales.select(
        "campaign_id", "campaign_name", "campaign_type", "region", "budget", "reach",
        (F.col("conversion_rate") * 100).alias("conversion_rate_pct"),
        F.col("sales").alias("nb_sales"),
        F.col("revenue").alias("total_sales"),
        num.quotient(F.col("revenue"), F.col("budget"), 8).alias("roi_ratio"),
    )
    return top(report, limit, *_best_first())


def _best_first():
    return F.col("roi_ratio").desc_nulls_last(), ascending("campaign_id")


def campaign_type_table(campaigns: DataFrame) -> DataFrame:
    return (
        campaigns.filter("budget > 0")
        .groupBy("campaign_type")
        .agg(
            F.count("*").alias("nb_campaigns"),
            num.total(F.col("budget")).alias("total_budget"),
            num.mean(F.col("budget"), 8).alias("avg_budget"),
            num.mean_pct(F.col("conversion_rate"), 8).alias("avg_conversion_pct"),
            num.mean_int(F.col("reach"), 6).alias("avg_reach"),
        )
        .orderBy(descending("avg_conversion_pct"), ascending("campaign_type"))
    )


def audience_table(campaigns: DataFrame, limit: int | None = 15) -> DataFrame:
    report = (
        campaigns.filter("target_audience IS NOT NULL")
        .groupBy("target_audience")
        .agg(
            F.count("*").alias("nb_campaigns"),
            num.mean_pct(F.col("conversion_rate"), 8).alias("avg_conversion_pct"),
            num.total(F.col("budget")).alias("total_budget"),
        )
    )
    return top(report, limit, descending("avg_conversion_pct"), ascending("target_audience"))


def marketing_kpis(dashboard: DataFrame) -> DataFrame:
    """Totals over the campaigns of ``dashboard``; give it without a limit for all of them."""
    budget, sales = F.sum("budget"), F.sum("total_sales")
    return dashboard.agg(
        F.coalesce(budget, F.lit(0)).cast("decimal(28,2)").alias("total_budget"),
        F.coalesce(sales, F.lit(0)).cast("decimal(28,2)").alias("total_sales"),
        F.when(budget > 0, num.ratio_double(F.coalesce(sales, F.lit(0)), budget)).otherwise(0.0).alias("avg_roi"),
        F.coalesce(F.sum("reach"), F.lit(0)).alias("total_reach"),
    )


def top_campaigns(dashboard: DataFrame, limit: int = 10) -> DataFrame:
    return top(dashboard, limit, *_best_first())


def best_campaign_type(types: DataFrame) -> DataFrame:
    return top(types, 1, descending("avg_conversion_pct"), ascending("campaign_type")).select(
        "campaign_type", "avg_conversion_pct"
    )


def low_roi_alert(dashboard: DataFrame) -> DataFrame:
    """Campaigns of ``dashboard`` that earn less than they cost: how many, and their budget."""
    return dashboard.filter(F.col("roi_ratio") < LOW_ROI).agg(
        F.count("*").alias("nb_campaigns"),
        F.coalesce(F.sum("budget"), F.lit(0)).cast("decimal(28,2)").alias("total_budget"),
    )
