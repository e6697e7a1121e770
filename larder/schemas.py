"""Declared shape of the eleven raw tables.

A table is a list of columns plus how its landing file is read. ``type`` is the
stored Spark type, ``parse_as`` the decimal a text field must fit before it is
stored (so ``4.5`` in a whole-number column rounds instead of failing), and
``max_length`` the longest text a load accepts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    parse_as: str | None = None
    max_length: int | None = None
    comment: str = ""


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    file: str
    format: str
    primary_key: tuple[str, ...] = ()
    comment: str = ""

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        ddl = ", ".join(f"{c.name} {c.type}" for c in self.columns)
        return T.StructType.fromDDL(ddl)

    @property
    def text_schema(self) -> T.StructType:
        """Same columns, all strings: what the file reader is given."""
        return T.StructType([T.StructField(c.name, T.StringType()) for c in self.columns])

    def __getitem__(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


def text(name: str, max_length: int | None = None) -> Column:
    return Column(name, "string", max_length=max_length)


def day(name: str) -> Column:
    return Column(name, "date")


def money(name: str) -> Column:
    return Column(name, "decimal(18,2)", parse_as="decimal(18,2)")


def ratio(name: str) -> Column:
    return Column(name, "decimal(6,4)", parse_as="decimal(6,4)")


def whole(name: str) -> Column:
    return Column(name, "bigint", parse_as="decimal(18,0)")


def identifier(name: str) -> Column:
    return Column(name, "bigint", parse_as="decimal(38,0)")


def score(name: str) -> Column:
    # an int rather than a two-digit decimal: averages of decimal(2,0) lose digits
    return Column(name, "int", parse_as="decimal(2,0)")


# Table, column and file names, text lengths and numeric widths
# have to match the landing files and the queries users already run.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "customer_demographics",
            (
                identifier("customer_id"), text("name", 200), day("date_of_birth"), text("gender", 20),
                text("region", 100), text("country", 100), text("city", 100),
                text("marital_status", 50), money("annual_income"),
            ),
            "customer_demographics.csv", "csv", ("customer_id",), "Raw customers",
        ),
        Table(
            "customer_service_interactions",
            (
                text("interaction_id", 50), day("interaction_date"), text("interaction_type", 50),
                text("issue_category", 100), text("description"), money("duration_minutes"),
                text("resolution_status", 50), text("follow_up_required", 10),
                score("customer_satisfaction"),
            ),
            "customer_service_interactions.csv", "csv", ("interaction_id",), "Raw service contacts",
        ),
        Table(
            "financial_transactions",
            (
                text("transaction_id", 50), day("transaction_date"), text("transaction_type", 50),
                money("amount"), text("payment_method", 50), text("entity", 200),
                text("region", 100), text("account_code", 50),
            ),
            "financial_transactions.csv", "csv", ("transaction_id",), "Raw transactions",
        ),
        Table(
            "promotions_data",
            (
                text("promotion_id", 50), text("product_category", 100), text("promotion_type", 100),
                ratio("discount_percentage"), day("start_date"), day("end_date"), text("region", 100),
            ),
            "promotions-data.csv", "csv", ("promotion_id",), "Raw promotions",
        ),
        Table(
            "marketing_campaigns",
            (
                text("campaign_id", 50), text("campaign_name", 200), text("campaign_type", 100),
                text("product_category", 100), text("target_audience", 100), day("start_date"),
                day("end_date"), text("region", 100), money("budget"), whole("reach"),
                ratio("conversion_rate"),
            ),
            "marketing_campaigns.csv", "csv", ("campaign_id",), "Raw campaigns",
        ),
        Table(
            "product_reviews",
            (
                identifier("review_id"), text("product_id", 50), text("reviewer_id", 50),
                text("reviewer_name", 200), score("rating"), day("review_date"),
                text("review_title", 500), text("review_text"), text("product_category", 100),
            ),
            "product_reviews.csv", "tsv", ("review_id",), "Raw product reviews",
        ),
        Table(
            "logistics_and_shipping",
            (
                text("shipment_id", 50), text("order_id", 50), day("ship_date"),
                day("estimated_delivery"), text("shipping_method", 50), text("status", 50),
                money("shipping_cost"), text("destination_region", 100),
                text("destination_country", 100), text("carrier", 200),
            ),
            "logistics_and_shipping.csv", "csv", ("shipment_id",), "Raw shipments",
        ),
        Table(
            "supplier_information",
            (
                text("supplier_id", 50), text("supplier_name", 200), text("product_category", 100),
                text("region", 100), text("country", 100), text("city", 100), whole("lead_time"),
                ratio("reliability_score"), text("quality_rating", 5),
            ),
            "supplier_information.csv", "csv", ("supplier_id",), "Raw suppliers",
        ),
        Table(
            "employee_records",
            (
                text("employee_id", 50), text("name", 200), day("date_of_birth"), day("hire_date"),
                text("department", 100), text("job_title", 200), money("salary"),
                text("region", 100), text("country", 100), text("email", 254),
            ),
            "employee_records.csv", "csv", ("employee_id",), "Raw employees",
        ),
        Table(
            "inventory",
            (
                text("product_id", 50), text("product_category", 100), text("region", 100),
                text("country", 100), text("warehouse", 200), whole("current_stock"),
                whole("reorder_point"), whole("lead_time"), day("last_restock_date"),
            ),
            "inventory.json", "json", (), "Raw stock levels",
        ),
        Table(
            "store_locations",
            (
                text("store_id", 50), text("store_name", 200), text("store_type", 100),
                text("region", 100), text("country", 100), text("city", 100), text("address", 500),
                text("postal_code", 20), money("square_footage"), whole("employee_count"),
            ),
            "store_locations.json", "json", (), "Raw stores",
        ),
    )
}
