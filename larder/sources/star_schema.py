"""The eleven raw tables as views over a star-schema parquet folder.

Used for oracle checks and benchmarks. Every view reads its source tables
whole; derived columns plant the faults the cleaning layer is there for
(negative amounts, out-of-range scores, ends before starts, duplicate keys,
blank text).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.operators.clean import clean
from larder.schemas import TABLES


# Declared, so that opening a table does not start a job to read a file footer.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class StarSchema:
    """Raw and clean tables over ``folder``; nothing is read until used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def bronze(self, table: str) -> DataFrame:
        typed = [f"CAST({c.name} AS {c.type}) AS {c.name}" for c in TABLES[table].columns]
        return _VIEWS[table](self).selectExpr(*typed)

    def silver(self, table: str) -> DataFrame:
        return clean(self.bronze(table), table)

    def with_region(self, df: DataFrame, nation_key: str) -> DataFrame:
        """Rows of ``df`` with nation and region, joined one small table at a time.

        Facts meet customers or suppliers first: joined to their nations beforehand, these
        have no measured size, and the facts would be shuffled for them whatever it is.
        """
        nation = self.source("nation")
        region = self.source("region")
        return df.join(nation, df[nation_key] == nation["n_nationkey"]).join(
            region, nation["n_regionkey"] == region["r_regionkey"]
        )

    def customers_located(self) -> DataFrame:
        return self.with_region(self.source("customer"), "c_nationkey")

    def suppliers_located(self) -> DataFrame:
        return self.with_region(self.source("supplier"), "s_nationkey")


def _customer_demographics(s: StarSchema) -> DataFrame:
    return s.customers_located().selectExpr(
        "c_custkey AS customer_id",
        "c_name AS name",
        "CASE WHEN c_custkey % 17 = 0 THEN NULL "
        "ELSE date_add(DATE '1940-01-01', CAST(c_custkey * 97 % 25000 AS INT)) END AS date_of_birth",
        "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
        "r_name AS region",
        "n_name AS country",
        "CASE WHEN c_custkey % 13 = 0 THEN '' "
        "ELSE concat(' City', CAST(c_custkey % 50 AS STRING), ' ') END AS city",
        "c_mktsegment AS marital_status",
        "CAST(c_acctbal AS DECIMAL(18,2)) * 12 AS annual_income",
    )


def _customer_service_interactions(s: StarSchema) -> DataFrame:
    return s.source("events").selectExpr(
        "CAST(event_id AS STRING) AS interaction_id",
        "CAST(ts AS DATE) AS interaction_date",
        "event_type AS interaction_type",
        "concat('I', CAST(user_id % 6 AS STRING)) AS issue_category",
        "props AS description",
        "CAST(CAST(value AS DECIMAL(18,2)) * 0.1 AS DECIMAL(18,2)) AS duration_minutes",
        "CASE WHEN event_id % 3 <> 0 THEN 'Resolved' ELSE 'Open' END AS resolution_status",
        "CASE WHEN event_id % 4 = 0 THEN 'Yes' ELSE 'No' END AS follow_up_required",
        "user_id % 7 AS customer_satisfaction",
    )


def _financial_transactions(s: StarSchema) -> DataFrame:
    orders = s.source("orders").selectExpr(
        "o_custkey", "o_orderkey", "CAST(o_orderdate AS DATE) AS transaction_date", "o_orderstatus",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS amount", "o_orderpriority",
    )
    customers = s.source("customer")
    return s.with_region(orders.join(customers, orders["o_custkey"] == customers["c_custkey"]), "c_nationkey").selectExpr(
        "CAST(o_orderkey AS STRING) AS transaction_id",
        "transaction_date",
        "CASE o_orderstatus WHEN 'F' THEN 'Sale' WHEN 'O' THEN 'Refund' ELSE 'Expense' END AS transaction_type",
        "amount",
        "o_orderpriority AS payment_method",
        "c_mktsegment AS entity",
        "r_name AS region",
        "n_name AS account_code",
    )


def _promotions_data(s: StarSchema) -> DataFrame:
    part = s.source("part")
    region = s.source("region")
    return part.join(region, part["p_partkey"] % 5 == region["r_regionkey"]).selectExpr(
        "concat('PR', CAST(p_partkey AS STRING)) AS promotion_id",
        "p_brand AS product_category",
        "p_type AS promotion_type",
        "CAST(p_size * 0.0095 AS DECIMAL(6,4)) AS discount_percentage",
        "date_add(DATE '1995-01-01', CAST(p_partkey % 2400 AS INT)) AS start_date",
        "date_add(DATE '1995-01-01', CAST(p_partkey % 2400 AS INT) + p_size - 3) AS end_date",
        "r_name AS region",
    )


def _marketing_campaigns(s: StarSchema) -> DataFrame:
    opening = "date_add(DATE '1995-01-01', CAST(s_suppkey * 37 % 2300 AS INT))"
    return s.suppliers_located().selectExpr(
        "concat('C', CAST(s_suppkey AS STRING)) AS campaign_id",
        "s_name AS campaign_name",
        "concat('T', CAST(s_suppkey % 5 AS STRING)) AS campaign_type",
        "concat('P', CAST(s_suppkey % 6 AS STRING)) AS product_category",
        "concat('A', CAST(s_suppkey % 4 AS STRING)) AS target_audience",
        f"{opening} AS start_date",
        f"date_add({opening}, CAST(30 + s_suppkey % 60 AS INT)) AS end_date",
        "r_name AS region",
        "CAST(s_acctbal AS DECIMAL(18,2)) AS budget",
        "s_suppkey * 10 AS reach",
        "CAST((s_suppkey % 120) * 0.01 AS DECIMAL(6,4)) AS conversion_rate",
    )


def _product_reviews(s: StarSchema) -> DataFrame:
    lineitem = s.source("lineitem").selectExpr(
        "l_partkey", "l_orderkey * 10 + l_linenumber AS review_id", "l_suppkey", "CAST(l_quantity AS INT) AS quantity",
        "CAST(l_shipdate AS DATE) AS review_date", "concat(l_returnflag, ' ', l_linestatus) AS review_text",
    )
    part = s.source("part")
    return lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"]).selectExpr(
        "review_id",
        "concat('P', CAST(l_partkey AS STRING)) AS product_id",
        "CAST(l_suppkey AS STRING) AS reviewer_id",
        "concat('Reviewer ', CAST(l_suppkey AS STRING)) AS reviewer_name",
        "quantity % 7 AS rating",
        "review_date",
        "concat(' ', p_name, ' ') AS review_title",
        "review_text",
        "p_type AS product_category",
    )


def _logistics_and_shipping(s: StarSchema) -> DataFrame:
    lineitem = s.source("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", "CAST(l_shipdate AS DATE) AS estimated_delivery", "l_returnflag",
        "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS shipping_cost",
    )
    orders = s.source("orders").selectExpr("o_orderkey", "CAST(o_orderdate AS DATE) AS ship_date", "o_orderstatus")
    supplier = s.source("supplier")
    shipped = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"]).join(
        supplier, lineitem["l_suppkey"] == supplier["s_suppkey"]
    )
    return s.with_region(shipped, "s_nationkey").selectExpr(
        "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS shipment_id",
        "CAST(l_orderkey AS STRING) AS order_id",
        "ship_date",
        "estimated_delivery",
        "l_returnflag AS shipping_method",
        "CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'In transit' ELSE 'Returned' END AS status",
        "shipping_cost",
        "r_name AS destination_region",
        "n_name AS destination_country",
        "s_name AS carrier",
    )


def _supplier_information(s: StarSchema) -> DataFrame:
    return s.suppliers_located().selectExpr(
        "CAST(s_suppkey AS STRING) AS supplier_id",
        "s_name AS supplier_name",
        "concat('P', CAST(s_suppkey % 6 AS STRING)) AS product_category",
        "r_name AS region",
        "n_name AS country",
        "concat('City', CAST(s_suppkey % 50 AS STRING)) AS city",
        "s_suppkey % 40 - 2 AS lead_time",
        "CAST((s_suppkey % 120) * 0.01 AS DECIMAL(6,4)) AS reliability_score",
        "CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS quality_rating",
    )


def _employee_records(s: StarSchema) -> DataFrame:
    return s.customers_located().selectExpr(
        "CAST(c_custkey AS STRING) AS employee_id",
        "c_name AS name",
        "date_add(DATE '1940-01-01', CAST(c_custkey * 97 % 25000 AS INT)) AS date_of_birth",
        "date_add(DATE '2010-01-01', CAST(c_custkey % 4000 AS INT)) AS hire_date",
        "c_mktsegment AS department",
        "concat('Grade ', CAST(c_custkey % 9 AS STRING)) AS job_title",
        "CAST(c_acctbal AS DECIMAL(18,2)) AS salary",
        "r_name AS region",
        "n_name AS country",
        "concat(' ', upper(c_name), '@X.COM ') AS email",
    )


def _inventory(s: StarSchema) -> DataFrame:
    lineitem = s.source("lineitem").selectExpr(
        "l_partkey", "l_suppkey", "CAST(l_quantity AS INT) AS quantity", "l_linenumber",
        "CAST(l_shipdate AS DATE) AS last_restock_date",
    )
    part = s.source("part")
    supplier = s.source("supplier").select("s_suppkey", "s_nationkey")
    # parts last: rows of a product end side by side, and names are added to them there
    stock = lineitem.join(supplier, lineitem["l_suppkey"] == supplier["s_suppkey"]).join(
        part, lineitem["l_partkey"] == part["p_partkey"]
    )
    return s.with_region(stock, "s_nationkey").selectExpr(
        "concat('P', CAST(l_partkey AS STRING)) AS product_id",
        "p_type AS product_category",
        "r_name AS region",
        "n_name AS country",
        "concat('W', CAST(l_suppkey % 3 AS STRING)) AS warehouse",
        "quantity - 2 AS current_stock",
        "l_linenumber * 5 AS reorder_point",
        "l_suppkey % 30 AS lead_time",
        "last_restock_date",
    )


def _store_locations(s: StarSchema) -> DataFrame:
    return s.suppliers_located().selectExpr(
        "CAST(s_suppkey AS STRING) AS store_id",
        "s_name AS store_name",
        "concat('T', CAST(s_suppkey % 3 AS STRING)) AS store_type",
        "r_name AS region",
        "n_name AS country",
        "concat('City', CAST(s_suppkey % 50 AS STRING)) AS city",
        "CASE WHEN s_suppkey % 9 = 0 THEN NULL "
        "ELSE concat(CAST(s_suppkey AS STRING), ' Main Street') END AS address",
        "CAST(10000 + s_suppkey AS STRING) AS postal_code",
        "CAST(s_acctbal AS DECIMAL(18,2)) AS square_footage",
        "s_suppkey % 50 - 1 AS employee_count",
    )


_VIEWS: dict[str, Callable[[StarSchema], DataFrame]] = {
    "customer_demographics": _customer_demographics,
    "customer_service_interactions": _customer_service_interactions,
    "financial_transactions": _financial_transactions,
    "promotions_data": _promotions_data,
    "marketing_campaigns": _marketing_campaigns,
    "product_reviews": _product_reviews,
    "logistics_and_shipping": _logistics_and_shipping,
    "supplier_information": _supplier_information,
    "employee_records": _employee_records,
    "inventory": _inventory,
    "store_locations": _store_locations,
}
