"""Column rules, bands and calendar helpers on literal values."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larder.functions import bands, numeric as num, rules, temporal as t


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def text(v):
    return F.lit(v).cast("string")


@pytest.mark.parametrize("value, expected", [("", None), ("   ", ""), (" a ", "a"), (None, None), ("\ta", "\ta")])
def test_blank_to_null_tests_before_trimming(spark, value, expected):
    assert one(spark, rules.blank_to_null(text(value))) == expected


def test_blank_to_null_strict(spark):
    assert one(spark, rules.blank_to_null(text("   "), strict=True)) is None


def test_trim_only_keeps_empty_text(spark):
    assert one(spark, rules.trim_only(text("  "))) == ""


def test_email(spark):
    assert one(spark, rules.normalize_email(text(" A@B.C "))) == "a@b.c"


@pytest.mark.parametrize("value, expected", [(-1, None), (0, 0), (5, 5), (None, None)])
def test_non_negative(spark, value, expected):
    assert one(spark, rules.non_negative(F.lit(value).cast("int"))) == expected


@pytest.mark.parametrize("value, expected", [(0, None), (1, 1), (5, 5), (6, None), (None, None)])
def test_in_range(spark, value, expected):
    assert one(spark, rules.in_range(F.lit(value).cast("int"), 1, 5)) == expected


@pytest.mark.parametrize(
    "start, end, kept",
    [("2024-01-02", "2024-01-01", False), ("2024-01-01", "2024-01-01", True), (None, "2024-01-01", True)],
)
def test_fix_end(spark, start, end, kept):
    got = one(spark, rules.fix_end(text(start).cast("date"), text(end).cast("date")))
    assert (got is not None) == kept


def test_age_counts_year_boundaries(spark):
    born, day = F.lit("2000-12-31").cast("date"), t.as_of_date("2024-01-01")
    assert one(spark, t.year_boundaries(born, day)) == 24


def test_weekday_numbers(spark):
    sunday = F.lit("2024-01-07").cast("date")
    assert one(spark, t.day_name(sunday)) == "Sun"
    assert one(spark, t.day_number(sunday)) == 0
    assert one(spark, t.iso_day_number(sunday)) == 7


def test_months_and_quarters_stay_dates(spark):
    day = F.lit("2024-05-17").cast("date")
    assert str(one(spark, t.month_of(day))) == "2024-05-01"
    assert str(one(spark, t.quarter_of(day))) == "2024-04-01"


def dec(v, kind):
    return F.lit(v).cast(kind)


@pytest.mark.parametrize(
    "value, closed, stepped",
    [
        ("0.0999", "< 10%", "< 10%"), ("0.1000", "10-19%", "10-19%"), ("0.1900", "10-19%", "10-19%"),
        ("0.1950", "40%+", "10-19%"), ("0.3999", "40%+", "30-39%"), ("0.4000", "40%+", "40%+"),
    ],
)
def test_discount_bands_differ_in_the_gaps(spark, value, closed, stepped):
    c = dec(value, "decimal(6,4)")
    assert one(spark, bands.closed_band(c, bands.DISCOUNT_GROUPS)) == closed
    assert one(spark, bands.stepped_band(c, bands.DISCOUNT_STEPS)) == stepped


def test_gaps_in_minutes_and_income(spark):
    assert one(spark, bands.closed_band(dec("9.5", "decimal(18,2)"), bands.DURATION_GROUPS)) == "30+ min"
    income = dec("49999.50", "decimal(18,2)")
    assert one(spark, bands.closed_band(income, bands.INCOME_GROUPS)) == "100K+"
    assert one(spark, bands.stepped_band(income, bands.INCOME_SEGMENTS)) == "20k-49k"


def test_missing_segment(spark):
    assert one(spark, bands.stepped_band(F.lit(None).cast("int"), bands.AGE_SEGMENTS)) == "NA"


@pytest.mark.parametrize("value, label", [("4.50", "Excellent (4.5-5.0)"), ("4.49", "Très bon (4.0-4.4)"), ("2.99", "Faible (< 3.0)")])
def test_rating_classes(spark, value, label):
    assert one(spark, bands.graded_band(dec(value, "decimal(28,2)"), bands.RATING_CLASSES)) == label


def test_mean_rounds_half_away_on_the_exact_quotient(spark):
    df = spark.createDataFrame([(Decimal("10.01"),), (Decimal("10.02"),), (None,)], "x decimal(18,2)")
    assert df.agg(num.mean(F.col("x"), 2)).first()[0] == Decimal("10.02")


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x decimal(18,2)")
    assert df.agg(num.mean(F.col("x"), 2)).first()[0] is None


def test_integer_mean_and_percent(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    got = df.agg(num.mean_int(F.col("x"), 2), num.percent(num.count_if(F.col("x") == 2), F.count("*"))).first()
    assert tuple(got) == (Decimal("1.67"), Decimal("66.67"))


def test_quotient_is_rounded_once(spark):
    # 279543.4883691449...: at ten digits it would look like a tie at eight
    df = spark.createDataFrame([(Decimal("44103576.16"), Decimal("157.77"))], "a decimal(28,2), b decimal(18,2)")
    assert df.select(num.quotient(F.col("a"), F.col("b"), 8)).first()[0] == Decimal("279543.48836914")


def test_quotient_of_huge_values(spark):
    df = spark.createDataFrame([(Decimal(10) ** 24, Decimal(4)), (Decimal(1), Decimal(0))], "a decimal(28,2), b decimal(18,2)")
    got = [r[0] for r in df.select(num.quotient(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [Decimal(10) ** 24 / 4, None]
