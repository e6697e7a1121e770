"""Customer segments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from larder.functions import bands, numeric as num, temporal as t
from larder.operators.ranking import ascending, descending
from larder.operators.shares import share, with_overall_share


def age_group_distribution(customers: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    age = t.year_boundaries(F.col("date_of_birth"), t.as_of_date(as_of))
    groups = (
        customers.filter("date_of_birth IS NOT NULL")
        .groupBy(bands.stepped_band(age, bands.AGE_GROUPS).alias("age_group"))
        .agg(F.count("*").alias("nb_customers"), num.mean(F.col("annual_income"), 2).alias("avg_income"))
    )
    return groups.select(
        "age_group", "nb_customers", share(F.col("nb_customers")).alias("pct_customers"), "avg_income"
    ).orderBy("age_group")


def income_bracket_distribution(customers: DataFrame) -> DataFrame:
    bracket = bands.closed_band(F.col("annual_income"), bands.INCOME_GROUPS)
    groups = (
        customers.filter("annual_income IS NOT NULL")
        .groupBy(bracket.alias("income_bracket"))
        .agg(F.count("*").alias("nb_customers"))
    )
    return groups.withColumn("pct_customers", share(F.col("nb_customers"))).orderBy(
        bands.band_rank(F.col("income_bracket"), bands.INCOME_GROUPS)
    )


def region_gender_distribution(customers: DataFrame) -> DataFrame:
    groups = (
        customers.filter("region IS NOT NULL AND gender IS NOT NULL")
        .groupBy("region", "gender")
        .agg(F.count("*").alias("nb_customers"), num.mean(F.col("annual_income"), 2).alias("avg_income"))
    )
    return groups.withColumn("pct_in_region", share(F.col("nb_customers"), "region")).orderBy(
        "region", descending("nb_customers"), "gender"
    )


def customer_geography(customers: DataFrame) -> DataFrame:
    """Customers per region, country and city with their share of all customers."""
    places = customers.groupBy("region", "country", "city").agg(F.count("*").alias("nb_customers"))
    return with_overall_share(places, "nb_customers", "pct_customers").orderBy(
        descending("nb_customers"), ascending("region"), ascending("country"), ascending("city")
    )
