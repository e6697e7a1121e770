"""Customer service reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.functions import bands, numeric as num
from larder.operators.ranking import ascending, descending, top

RESOLVED = "Resolved"  # fixed value


def service_satisfaction(interactions: DataFrame, limit: int | None = 20) -> DataFrame:
    resolved = num.count_if(F.col("resolution_status") == RESOLVED)
    report = (
        interactions.filter("interaction_type IS NOT NULL AND issue_category IS NOT NULL")
        .groupBy("interaction_type", "issue_category")
        .agg(
            F.count("*").alias("nb_interactions"),
            num.mean_int(F.col("customer_satisfaction"), 2).alias("avg_satisfaction"),
            num.mean(F.col("duration_minutes"), 1).alias("avg_duration_min"),
            resolved.alias("nb_resolved"),
            num.percent(resolved, F.count("*")).alias("resolution_rate_pct"),
        )
    )
    return top(
        report, limit,
        descending("avg_satisfaction"), ascending("interaction_type"), ascending("issue_category"),
    )


def duration_bucket_satisfaction(interactions: DataFrame) -> DataFrame:
    bucket = bands.closed_band(F.col("duration_minutes"), bands.DURATION_GROUPS)
    return (
        interactions.filter("duration_minutes IS NOT NULL AND customer_satisfaction IS NOT NULL")
        .groupBy(bucket.alias("duration_bucket"))
        .agg(
            F.count("*").alias("nb_interactions"),
            num.mean_int(F.col("customer_satisfaction"), 2).alias("avg_satisfaction"),
        )
        .orderBy("duration_bucket")
    )


def duration_satisfaction_correlation(interactions: DataFrame) -> DataFrame:
    pair = interactions.filter("duration_minutes IS NOT NULL AND customer_satisfaction IS NOT NULL")
    return pair.agg(
        F.count("*").alias("nb_interactions"),
        F.round(num.correlation(F.col("duration_minutes") * 100, F.col("customer_satisfaction")), 6).alias("correlation"),
    )
