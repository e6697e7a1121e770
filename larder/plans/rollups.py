"""Sales reports from a stored daily roll-up.

The roll-up holds, for every day, region and payment method, the number of sales
and their total as a decimal: figures that add up. It is kept in the partitions
of the clean table it is made from, so a merge into some of them is followed by
a new roll-up of those alone, and a late duplicate that changes a sale changes
its old total too. Reports read the roll-up, whose size follows days, regions
and methods, and give what they give over the sales themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from larder.functions import numeric as num, temporal as t
from larder.plans.sales import is_sale
from larder.sinks.merges import PART
from larder.sinks.tables import ONLY_WRITTEN

_BY = ["transaction_date", "region", "payment_method"]


def daily_rollup(transactions: DataFrame, *also: str) -> DataFrame:
    """transaction_date, region, payment_method, nb_sales, total of sales with an amount; ``also`` are further keys."""
    priced = transactions.filter(is_sale() & F.col("amount").isNotNull())
    sums = priced.groupBy(*_BY, *also).agg(F.count("*").alias("nb_sales"), num.total(F.col("amount")).alias("total"))
    return sums.select(*_BY, "nb_sales", "total", *also)


def refresh_rollup(spark: SparkSession, clean_table: str, rollup: str, touched: Sequence[int]) -> None:
    """Roll up the partitions ``touched`` of a merged clean table again; others of ``rollup`` stay."""
    if not spark.catalog.tableExists(rollup):
        empty = daily_rollup(spark.table(clean_table).limit(0), PART)
        empty.write.format("parquet").options(**ONLY_WRITTEN).partitionBy(PART).saveAsTable(rollup)
    if not touched:
        return
    rows = daily_rollup(spark.table(clean_table).where(F.col(PART).isin(list(touched))), PART)
    held = {r[0] for r in rows.select(PART).distinct().collect()}
    rows.hint("rebalance", PART).write.mode("overwrite").insertInto(rollup)
    for part in set(touched) - held:  # a partition left without sales
        spark.sql(f"ALTER TABLE {rollup} DROP IF EXISTS PARTITION ({PART} = {int(part)})")
    spark.catalog.refreshTable(rollup)


def _report(rollup: DataFrame, average: str, *keys: Column) -> DataFrame:
    n, total = F.sum("nb_sales"), F.sum("total")
    return rollup.groupBy(*keys).agg(
        n.alias("nb_transactions"), total.cast("decimal(28,2)").alias("total_sales"),
        num.quotient(total, n, 2).alias(average),
    )


def _dated(rollup: DataFrame) -> DataFrame:
    return rollup.filter("transaction_date IS NOT NULL")


def monthly_sales(rollup: DataFrame) -> DataFrame:
    return _report(_dated(rollup), "avg_transaction_value", t.month_of(F.col("transaction_date")).alias("month")).orderBy("month")


def quarterly_sales(rollup: DataFrame) -> DataFrame:
    return _report(_dated(rollup), "avg_transaction_value", t.quarter_of(F.col("transaction_date")).alias("quarter")).orderBy("quarter")


def weekday_sales(rollup: DataFrame) -> DataFrame:
    day = F.col("transaction_date")
    keys = (t.day_name(day).alias("day_of_week"), t.day_number(day).alias("day_num"))
    return _report(_dated(rollup), "avg_transaction_value", *keys).orderBy("day_num")


def region_sales(rollup: DataFrame) -> DataFrame:
    return _report(rollup.filter("region IS NOT NULL"), "avg_transaction", F.col("region")).orderBy("region")
