"""Row counts, key and value checks, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from larder.operators.clean import Cleaning
from larder.operators.shares import share


def uniqueness_check(df: DataFrame, *key: str) -> DataFrame:
    """Rows against distinct keys; equal when the key is unique and never NULL."""
    return df.agg(F.count("*").alias("nb"), F.count_distinct(*key).alias("nb_distinct"))


def negative_amount_check(df: DataFrame, column: str = "amount") -> DataFrame:
    return df.filter(F.col(column) < 0).agg(F.count("*").alias("nb_negatifs"))


def age_bounds_check(customers: DataFrame) -> DataFrame:
    """Ages outside 0 to 120; an unknown age is not counted."""
    age = F.col("age")
    return customers.agg(
        F.sum(F.when((age < 0) | (age > 120), 1).otherwise(0)).alias("nb_ages_incoherents")
    )


def raw_checks(spec: Cleaning) -> list[Column]:
    """What a raw table's rows break, as aggregates that a scan can carry along."""

    def times(conditions: list[Column]) -> Column:
        return F.coalesce(F.sum(sum((F.when(c, 1).otherwise(0) for c in conditions), F.lit(0))), F.lit(0)).cast("bigint")

    start, end = spec.interval or (None, None)
    no_key = reduce(Column.__or__, [F.col(c).isNull() for c in spec.key])
    return [
        F.count("*").alias("raw_rows"),
        times([no_key]).alias("null_key_rows"),
        times([F.col(c) < 0 for c in spec.non_negative]).alias("negative_values"),
        times([~F.col(c).between(*bounds) for c, bounds in spec.ranges.items()]).alias("out_of_range_values"),
        times([F.col(start) > F.col(end)] if start else []).alias("reversed_periods"),
    ]


def row_count(df: DataFrame, name: str = "nb") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def volumes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, as a single job."""
    counts = [
        df.agg(F.count("*").alias("rows_cnt")).select(F.lit(name).alias("table_name"), "rows_cnt")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def sample_rows(df: DataFrame, order: Sequence[str], limit: int = 10) -> DataFrame:
    """First rows in a fixed order, so that two looks at a table agree."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(limit)


def table_overview(tables: Mapping[str, tuple[DataFrame, str | None, Sequence[str]]]) -> DataFrame:
    """Per table: rows, period covered and distinct keys.

    Each entry is (frame, date column or None, key columns). Keys containing a
    NULL are left out of the distinct count.
    """

    def overview(name: str, df: DataFrame, date: str | None, key: Sequence[str]) -> DataFrame:
        day = F.col(date) if date else F.lit(None).cast("date")
        return df.agg(
            F.count("*").alias("nb_rows"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
            F.count_distinct(*key).alias("nb_keys"),
        ).select(F.lit(name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, [overview(n, *t) for n, t in tables.items()]).orderBy("table_name")


def missing_values_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs per table and column. One pass and one small row per table, then unpivoted."""

    def profile(name: str, df: DataFrame) -> DataFrame:
        missing = df.agg(
            F.count("*").alias("nb_rows"),
            *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns],
        )
        return missing.unpivot("nb_rows", list(df.columns), "column_name", "nb_missing").select(
            F.lit(name).alias("table_name"), "column_name", "nb_missing", "nb_rows"
        )

    return reduce(DataFrame.unionByName, [profile(n, df) for n, df in tables.items()]).orderBy(
        "table_name", "column_name"
    )


def dimension_distribution(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Rows per value of each dimension with the share inside that dimension.

    One scan for all dimensions; each map task sends only its partial counts.
    """
    text = [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions]
    counts = (
        df.select(F.explode(F.array(*text)).alias("d"))
        .groupBy("d.dimension", "d.value")
        .agg(F.count("*").alias("nb_rows"))
    )
    return counts.withColumn("pct_rows", share(F.col("nb_rows"), "dimension")).orderBy(
        "dimension", F.col("nb_rows").desc(), F.col("value").asc_nulls_last()
    )


# about 2^14 registers: a standard error near 0.8 per cent
_SKETCH_SIZE = 14


def key_sketches(df: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns and a sketch of the distinct keys of each group; keys with a NULL are left out.

    Every task sends one small sketch a group instead of its keys. Stored with a
    table's partitions, sketches of new partitions are merged with the old ones.
    """
    whole = df.dropna(subset=list(key))
    text = F.to_json(F.struct(*key))
    return whole.groupBy(*by).agg(F.hll_sketch_agg(text, F.lit(_SKETCH_SIZE)).alias("sketch"))


def sketched_keys(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns and nb_keys_estimated: the distinct keys of merged sketches, right to about 2 per cent."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("nb_keys_estimated"))
