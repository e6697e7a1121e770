"""The cleaning jobs: survivors, keys, idempotence, plan shape."""

import pytest
from pyspark.sql import functions as F

from frames import rows, table
from larder.operators.clean import CLEANINGS, apply_rules, clean, keep_one
from larder.schemas import TABLES
from larder.sources.star_schema import StarSchema


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_specs_name_existing_columns():
    for name, spec in CLEANINGS.items():
        columns = set(TABLES[name].names)
        used = {*spec.key, *spec.blank, *spec.trim, *spec.email, *spec.non_negative, *spec.ranges}
        used |= set(spec.interval or ()) | ({spec.newest} if spec.newest else set())
        assert used <= columns, name


def test_transactions(spark):
    raw = table(
        spark, "financial_transactions",
        {"transaction_id": " a ", "amount": -1, "region": ""},
        {"transaction_id": "b", "amount": 3, "entity": "   "},
    )
    got = {r["transaction_id"]: r for r in clean(raw, "financial_transactions").collect()}
    assert set(got) == {"a", "b"}
    assert got["a"]["amount"] is None and got["a"]["region"] is None
    assert got["b"]["entity"] == ""


def test_duplicates_and_null_keys_keep_one_row_each(spark):
    raw = table(
        spark, "financial_transactions",
        {"transaction_id": "a", "amount": 5}, {"transaction_id": "a", "amount": 2},
        {"transaction_id": None, "amount": 9}, {"transaction_id": None, "amount": 1},
        {"transaction_id": "", "amount": 7},
    )
    got = sorted((str(r["transaction_id"]), int(r["amount"])) for r in clean(raw, "financial_transactions").collect())
    # an empty id is NULL by then; the smallest amount survives
    assert got == [("None", 1), ("a", 2)]


def test_inventory_keeps_the_latest_dated_row(spark):
    key = {"product_id": "p", "country": "c", "warehouse": "w"}
    raw = table(
        spark, "inventory",
        {**key, "last_restock_date": None, "current_stock": 1},
        {**key, "last_restock_date": "2024-01-01", "current_stock": 2},
        {**key, "last_restock_date": "2024-03-01", "current_stock": 3},
    )
    assert [r["current_stock"] for r in clean(raw, "inventory").collect()] == [3]


def test_promotion_dates_and_discount(spark):
    raw = table(
        spark, "promotions_data",
        {"promotion_id": "a", "start_date": "2024-02-01", "end_date": "2024-01-01", "discount_percentage": 1.2},
        {"promotion_id": "b", "start_date": "2024-02-01", "end_date": "2024-02-01", "discount_percentage": 1},
        {"promotion_id": "c", "start_date": "2024-02-01", "end_date": None, "discount_percentage": 0},
    )
    got = {r["promotion_id"]: (r["end_date"], r["discount_percentage"]) for r in clean(raw, "promotions_data").collect()}
    assert got["a"] == (None, None)
    assert str(got["b"][0]) == "2024-02-01" and got["b"][1] == 1
    assert got["c"][0] is None and got["c"][1] == 0


def test_campaign_dates_are_left_alone(spark):
    raw = table(
        spark, "marketing_campaigns",
        {"campaign_id": "a", "start_date": "2024-02-01", "end_date": "2024-01-01", "conversion_rate": -0.1},
    )
    got = clean(raw, "marketing_campaigns").first()
    assert got["end_date"] is not None and got["conversion_rate"] is None


@pytest.mark.parametrize("name", list(CLEANINGS))
def test_clean_tables_hold_their_rules(spark, tiny, name):
    spec = CLEANINGS[name]
    source = StarSchema(spark, tiny)
    cleaned = source.silver(name).cache()
    assert cleaned.columns == TABLES[name].names
    n, keys = cleaned.agg(F.count("*"), F.count_distinct(F.struct(*spec.key))).first()
    assert n == keys == source.bronze(name).select(*spec.key).distinct().count()
    broken = [F.col(c) < 0 for c in spec.non_negative]
    broken += [~F.col(c).between(*bounds) for c, bounds in spec.ranges.items()]
    if spec.interval:
        broken.append(F.col(spec.interval[0]) > F.col(spec.interval[1]))
    for b in broken:
        assert cleaned.filter(b).isEmpty()
    again = clean(cleaned, name)
    assert again.exceptAll(cleaned).isEmpty() and again.count() == n
    cleaned.unpersist()


def test_rules_do_not_shuffle(spark, tiny):
    source = StarSchema(spark, tiny)
    p = plan(apply_rules(source.source("events").select("event_type", "props"), CLEANINGS["product_reviews"]))
    assert "Exchange" not in p


def test_hot_key_is_cut_before_the_shuffle(spark):
    # a third of the rows share one key
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("k"), (-F.col("id")).alias("v")
    ).repartition(8)
    one = keep_one(df, ("k",))
    assert one.count() == 20001
    assert rows(one.filter("k IS NULL")) == [(None, -29997)]
    p = plan(keep_one(df, ("k",)))
    assert p.count("WindowGroupLimit") == 2
    partial = p.index("Partial")
    exchange = p.rindex("Exchange hashpartitioning(k", 0, partial)
    assert exchange < partial  # printed top down: the partial limit feeds the exchange
