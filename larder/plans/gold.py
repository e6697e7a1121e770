"""Gold tables: sales, promotions and customers with derived columns.

Table and column names are the ones consumers already query.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from larder.functions import bands, temporal as t

FOREVER = "9999-12-31"  # fixed value: end of a promotion without an end


def enriched_sales(transactions: DataFrame) -> DataFrame:
    """Sale rows, whatever the case of their type, with calendar columns."""
    d = F.col("transaction_date")
    iso = t.iso_day_number(d)
    return transactions.filter(F.upper("transaction_type") == "SALE").select(
        "transaction_id",
        "transaction_date",
        F.year(d).alias("annee"),
        F.month(d).alias("mois"),
        F.date_format(d, "yyyy-MM").alias("mois_aaaamm"),
        iso.alias("jour_semaine_iso"),
        F.when(iso >= 6, 1).otherwise(0).alias("is_weekend"),
        "transaction_type", "amount", "payment_method", "entity", "region", "account_code",
    )


def promotion_activity(promotions: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """All promotions with a running flag and their length so far.

    Here, unlike in the sales joins, a promotion without an end is open. Its
    length is counted up to the reference day and is negative if it starts later.
    """
    today = t.as_of_date(as_of)
    start, end = F.col("start_date"), F.col("end_date")
    running = today.between(start, F.coalesce(end, F.lit(FOREVER).cast("date")))
    return promotions.select(
        "promotion_id", "product_category", "promotion_type", "discount_percentage",
        "start_date", "end_date", "region",
        F.when(running, 1).otherwise(0).alias("is_active"),
        t.days_between(start, F.coalesce(end, today)).alias("duree_jours"),
    )


def enriched_customers(customers: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    age = t.year_boundaries(F.col("date_of_birth"), t.as_of_date(as_of))
    return customers.select(
        "customer_id", "name", "date_of_birth",
        age.alias("age"),
        bands.stepped_band(age, bands.AGE_SEGMENTS).alias("age_segment"),
        "gender", "marital_status", "annual_income",
        bands.stepped_band(F.col("annual_income"), bands.INCOME_SEGMENTS).alias("income_bracket"),
        "region", "country", "city",
    )
