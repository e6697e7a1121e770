"""Product review reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.functions import bands, numeric as num
from larder.operators.ranking import ascending, descending, top
from larder.operators.shares import share


def top_categories_by_reviews(reviews: DataFrame, limit: int | None = 20) -> DataFrame:
    report = (
        reviews.filter("product_category IS NOT NULL")
        .groupBy("product_category")
        .agg(
            F.count("*").alias("nb_reviews"),
            num.mean_int(F.col("rating"), 2).alias("avg_rating"),
            F.count_distinct("product_id").alias("nb_products"),
        )
    )
    return top(report, limit, descending("nb_reviews"), ascending("product_category"))


def top_products_by_reviews(reviews: DataFrame, limit: int | None = 30) -> DataFrame:
    report = (
        reviews.filter("product_id IS NOT NULL")
        .groupBy("product_id", "product_category")
        .agg(
            F.count("*").alias("nb_reviews"),
            num.mean_int(F.col("rating"), 2).alias("avg_rating"),
            F.min("rating").alias("min_rating"),
            F.max("rating").alias("max_rating"),
        )
    )
    return top(report, limit, descending("nb_reviews"), ascending("product_id"), ascending("product_category"))


def product_performance(reviews: DataFrame) -> DataFrame:
    """Rated products: number of ratings, their average and spread."""
    return (
        reviews.filter("product_id IS NOT NULL AND rating IS NOT NULL")
        .groupBy("product_id", "product_category")
        .agg(
            F.count("*").alias("nb_reviews"),
            num.mean_int(F.col("rating"), 2).alias("avg_rating"),
            F.stddev_samp("rating").alias("rating_stddev"),
        )
    )


def rating_category_distribution(reviews: DataFrame) -> DataFrame:
    grade = bands.graded_band(F.col("avg_rating"), bands.RATING_CLASSES)
    return (
        product_performance(reviews)
        .groupBy(grade.alias("rating_category"))
        .agg(
            F.count("*").alias("nb_products"),
            num.mean_int(F.col("nb_reviews"), 1).alias("avg_reviews_per_product"),
            F.sum("nb_reviews").alias("total_reviews"),
        )
        .orderBy("rating_category")
    )


def rating_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per rating 1 to 5 with their share of all rated reviews."""
    counts = reviews.filter("rating IS NOT NULL").groupBy("rating").agg(F.count("*").alias("nb_reviews"))
    return counts.withColumn("pct_reviews", share(F.col("nb_reviews"))).orderBy("rating")


def review_volume_vs_rating(reviews: DataFrame) -> DataFrame:
    """Correlation, over products, of the number of ratings and the average rating."""
    return product_performance(reviews).agg(
        F.count("*").alias("nb_products"),
        F.round(num.correlation(F.col("nb_reviews"), F.col("avg_rating") * 100), 6).alias("correlation"),
    )
