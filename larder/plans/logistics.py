"""Stock and shipping reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from larder.functions import numeric as num, temporal as t
from larder.operators.ranking import ascending, descending, top

# Fixed values
DELIVERED = "Delivered"
LONG_DELIVERY_DAYS = 7
STOCK_METRIC = "Situation actuelle des stocks"


def _short() -> Column:
    return F.col("current_stock") < F.col("reorder_point")


def _delivery_days() -> Column:
    return t.days_between(F.col("ship_date"), F.col("estimated_delivery"))


def stock_status(inventory: DataFrame) -> DataFrame:
    short = num.count_if(_short())
    counted = inventory.filter("current_stock IS NOT NULL AND reorder_point IS NOT NULL").agg(
        short.alias("nb_stockouts"),
        num.count_if(~_short()).alias("nb_in_stock"),
        F.count("*").alias("total_products"),
        num.percent(short, F.count("*")).alias("stockout_rate_pct"),
    )
    return counted.select(F.lit(STOCK_METRIC).alias("metric"), "*")


def low_stock_by_category(inventory: DataFrame) -> DataFrame:
    return (
        inventory.filter(_short() & F.col("product_category").isNotNull())
        .groupBy("product_category")
        .agg(
            F.count("*").alias("nb_products_low_stock"),
            F.sum("current_stock").alias("total_current_stock"),
            F.sum("reorder_point").alias("total_reorder_point"),
            num.mean_int(F.col("lead_time"), 1).alias("avg_lead_time_days"),
        )
        .orderBy(descending("nb_products_low_stock"), ascending("product_category"))
    )


def stockouts_by_warehouse(inventory: DataFrame, limit: int | None = 20) -> DataFrame:
    short = num.count_if(_short())
    report = (
        inventory.dropna(subset=["country", "warehouse", "current_stock", "reorder_point"])
        .groupBy("country", "warehouse")
        .agg(
            F.count("*").alias("total_products"),
            short.alias("nb_stockouts"),
            num.percent(short, F.count("*")).alias("stockout_rate_pct"),
        )
    )
    return top(report, limit, descending("stockout_rate_pct"), ascending("country"), ascending("warehouse"))


def shipping_method_delay(shipments: DataFrame) -> DataFrame:
    days = _delivery_days()
    return (
        shipments.dropna(subset=["ship_date", "estimated_delivery", "shipping_method"])
        .groupBy("shipping_method")
        .agg(
            F.count("*").alias("nb_shipments"),
            num.mean(F.col("shipping_cost"), 2).alias("avg_cost"),
            num.mean_int(days, 1).alias("avg_delivery_days"),
            F.min(days).alias("min_delivery_days"),
            F.max(days).alias("max_delivery_days"),
        )
        .orderBy(ascending("avg_delivery_days"), ascending("shipping_method"))
    )


def region_logistics(shipments: DataFrame, limit: int | None = 20) -> DataFrame:
    delivered = num.count_if(F.col("status") == DELIVERED)
    report = (
        shipments.filter("destination_region IS NOT NULL AND ship_date IS NOT NULL")
        .groupBy("destination_region", "destination_country")
        .agg(
            F.count("*").alias("nb_shipments"),
            num.mean(F.col("shipping_cost"), 2).alias("avg_cost"),
            num.mean_int(_delivery_days(), 1).alias("avg_delivery_days"),
            delivered.alias("nb_delivered"),
            num.percent(delivered, F.count("*")).alias("delivery_success_rate_pct"),
        )
    )
    return top(
        report, limit,
        descending("nb_shipments"), ascending("destination_region"), ascending("destination_country"),
    )


def long_delivery_rate(shipments: DataFrame) -> DataFrame:
    days = _delivery_days()
    late = num.count_if(days > LONG_DELIVERY_DAYS)
    return (
        shipments.filter("ship_date IS NOT NULL AND estimated_delivery IS NOT NULL")
        .groupBy("shipping_method")
        .agg(
            F.count("*").alias("nb_shipments"),
            num.mean_int(days, 1).alias("avg_expected_days"),
            late.alias("nb_long_delivery"),
            num.percent(late, F.count("*")).alias("long_delivery_rate_pct"),
        )
        .orderBy(descending("long_delivery_rate_pct"), ascending("shipping_method"))
    )


def carrier_cost_comparison(shipments: DataFrame) -> DataFrame:
    """Shipments and cost per carrier, dearest average first."""
    cost = F.col("shipping_cost")
    return (
        shipments.filter("carrier IS NOT NULL")
        .groupBy("carrier")
        .agg(
            F.count("*").alias("nb_shipments"),
            num.total(cost).alias("total_cost"),
            num.mean(cost, 2).alias("avg_cost"),
            F.min(cost).alias("min_cost"),
            F.max(cost).alias("max_cost"),
        )
        .orderBy(descending("avg_cost"), ascending("carrier"))
    )


def delivery_by_method_region(shipments: DataFrame) -> DataFrame:
    """Delivery days per shipping method and destination region."""
    days = _delivery_days()
    return (
        shipments.dropna(subset=["ship_date", "estimated_delivery", "shipping_method", "destination_region"])
        .groupBy("shipping_method", "destination_region")
        .agg(
            F.count("*").alias("nb_shipments"),
            num.mean_int(days, 1).alias("avg_delivery_days"),
            F.min(days).alias("min_delivery_days"),
            F.max(days).alias("max_delivery_days"),
        )
        .orderBy(ascending("shipping_method"), ascending("destination_region"))
    )
