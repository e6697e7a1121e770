"""Sums that must hold on any data."""

import pytest
from pyspark.sql import functions as F

from larder.catalogue import QUERIES
from row_join import sales_promotion_overlap

# query -> (share column, group it adds up in, slack for rounding each row)
SHARES = {
    "region_sales_share": ("pct_total_sales", None),
    "age_group_distribution": ("pct_customers", None),
    "income_bracket_distribution": ("pct_customers", None),
    "region_gender_distribution": ("pct_in_region", "region"),
    "promo_impact": ("pct_volume", None),
    "rating_distribution": ("pct_reviews", None),
    "customer_dimension_distribution": ("pct_rows", "dimension"),
}


@pytest.mark.parametrize("name", SHARES)
def test_shares_add_up(stored, name):
    column, group = SHARES[name]
    df = QUERIES[name].on(stored)
    sums = (df.groupBy(group) if group else df.groupBy()).agg(F.sum(column), F.count("*")).collect()
    for row in sums:
        total, n = row[-2:]
        assert abs(float(total) - 100) <= 0.005 * n + 1e-9


# query -> (count column, raw table, filter selecting the rows that are counted)
PARTS = {
    "monthly_sales_mom": ("nb_transactions", "financial_transactions", "transaction_type = 'Sale' AND amount IS NOT NULL"),
    "income_bracket_distribution": ("nb_customers", "customer_demographics", "annual_income IS NOT NULL"),
    "age_group_distribution": ("nb_customers", "customer_demographics", "date_of_birth IS NOT NULL"),
    "discount_band_distribution": ("nb_promotions", "promotions_data", "discount_percentage IS NOT NULL"),
    "duration_bucket_satisfaction": (
        "nb_interactions", "customer_service_interactions",
        "duration_minutes IS NOT NULL AND customer_satisfaction IS NOT NULL",
    ),
    "rating_category_distribution": ("total_reviews", "product_reviews", "product_id IS NOT NULL AND rating IS NOT NULL"),
    "long_delivery_rate": ("nb_shipments", "logistics_and_shipping", "ship_date IS NOT NULL AND estimated_delivery IS NOT NULL"),
    "customer_geography": ("nb_customers", "customer_demographics", "true"),
}


@pytest.mark.parametrize("name", PARTS)
def test_bands_cover_every_row_once(stored, name):
    column, table, kept = PARTS[name]
    counted = QUERIES[name].on(stored).agg(F.sum(column)).first()[0]
    assert counted == stored(table).filter(kept).count()


def test_impact_equals_the_row_level_join(stored):
    rows = sales_promotion_overlap(stored("financial_transactions"), stored("promotions_data"))
    by_rows = rows.groupBy("promo_status").agg(F.count("*"), F.sum("amount")).orderBy("promo_status").collect()
    summed = QUERIES["promo_impact"].on(stored).orderBy("promo_status").collect()
    assert [tuple(r) for r in by_rows] == [tuple(r)[:3] for r in summed]
