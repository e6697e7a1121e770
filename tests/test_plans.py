"""What the physical plans must and must not contain."""

import pytest

from larder.catalogue import QUERIES, Report


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [n for n in QUERIES if isinstance(QUERIES[n], Report)]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(stored, name):
    p = plan(QUERIES[name].on(stored))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in p


@pytest.fixture(autouse=True, scope="module")
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_filters_and_columns_reach_the_scan(stored):
    p = plan(QUERIES["monthly_sales_mom"].on(stored))
    assert "EqualTo(transaction_type,Sale)" in p and "IsNotNull(amount)" in p
    schema = p.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(c.split(":")[0] for c in schema.split(",") if ":" in c) == [
        "amount", "transaction_date", "transaction_type",
    ]


def test_promotion_filters_reach_the_promotion_scan(stored):
    p = plan(QUERIES["filtered_promo_impact"].on(stored))
    assert "In(region, [ASIA,EUROPE,MIDDLE EAST])" in p and "In(product_category" in p


def test_promo_impact_joins_nothing(stored):
    p = plan(QUERIES["promo_impact"].on(stored))
    assert "Join" not in p


def test_facts_shuffle_once_and_only_as_partial_sums(stored):
    p = plan(QUERIES["promo_impact"].on(stored))
    # every exchange is above a partial aggregate or the window over daily rows
    scan = p.index("FileScan")
    lowest_exchange = p.rindex("Exchange", 0, scan)
    assert "partial_sum(rows" in p[lowest_exchange:scan]


def test_top_k_is_not_a_full_sort(stored):
    for name in ("top_products_by_reviews", "campaign_roi_top20", "stockouts_by_warehouse"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name].on(stored))


def test_geography_share_does_not_gather_rows(stored):
    p = plan(QUERIES["customer_geography"].on(stored))
    assert "Window" not in p


def test_same_result_from_stored_and_raw(spark, tiny, stored):
    for name in ("promo_impact", "rating_category_distribution", "stock_status"):
        assert QUERIES[name].on(stored).collect() == QUERIES[name](spark, tiny).collect()
