"""Landing files with planted faults, written from the raw tables.

Feeds the loader checks: the whole table goes out in the format its loader
expects, with bad numbers, bad dates, missing keys, over-long text and wrong
field counts in known rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.plans.layers import run_together
from larder.schemas import TABLES
from larder.session import scratch_folder
from larder.sources.star_schema import StarSchema


@dataclass(frozen=True)
class Planted:
    """What is spoilt in a table's rows: those whose number ends in 3, 5, 7, ... of 20."""

    number: str
    day: str | None
    figure: str
    text: str


PLANTED = {
    "customer_demographics": Planted("customer_id", "date_of_birth", "annual_income", "gender"),
    "customer_service_interactions": Planted(
        "CAST(interaction_id AS BIGINT)", "interaction_date", "duration_minutes", "follow_up_required"
    ),
    "promotions_data": Planted("CAST(substr(promotion_id, 3) AS BIGINT)", "start_date", "discount_percentage", "promotion_type"),
    "marketing_campaigns": Planted("CAST(substr(campaign_id, 2) AS BIGINT)", "start_date", "budget", "campaign_type"),
    "logistics_and_shipping": Planted(
        "CAST(split_part(shipment_id, '-', 1) AS BIGINT) * 8 + CAST(split_part(shipment_id, '-', 2) AS BIGINT)",
        "ship_date", "shipping_cost", "status",
    ),
    "supplier_information": Planted("CAST(supplier_id AS BIGINT)", None, "lead_time", "quality_rating"),
    "employee_records": Planted("CAST(employee_id AS BIGINT)", "hire_date", "salary", "department"),
}


def table_csv(s: StarSchema, name: str, folder: str | None = None) -> str:
    """A whole table as CSV, text in quotes, with the faults that ``PLANTED`` names."""
    table, planted = TABLES[name], PLANTED[name]
    n = "_n"

    def field(column) -> str:
        text = f"CAST({column.name} AS STRING)"
        if column.type == "string":
            text = f"concat('\"', replace({column.name}, '\"', '\"\"'), '\"')"
        if column.name == planted.day:
            text = f"CASE WHEN {n} = 3 THEN 'someday' ELSE {text} END"
        if column.name == planted.figure:
            text = f"CASE WHEN {n} = 5 THEN 'bad' ELSE {text} END"
        if column.name in table.primary_key:
            text = f"CASE WHEN {n} = 7 THEN '  ' ELSE {text} END"
        if column.name == planted.text:
            text = f"CASE {n} WHEN 11 THEN repeat('x', {column.max_length + 1}) WHEN 17 THEN 'NULL' ELSE {text} END"
        return f"coalesce({text}, '')"

    fields = ", ".join(map(field, table.columns))
    numbered = s.bronze(name).withColumn(n, F.expr(f"({planted.number}) % 20"))
    lines = numbered.selectExpr(f"concat(concat_ws(',', {fields}), CASE WHEN {n} = 13 THEN ',extra' ELSE '' END)")
    return _write_lines(s.spark, lines, ",".join(table.names), name, folder)


def whole_landing(s: StarSchema) -> str:
    """A folder with the landing file of every table, faults in each."""
    folder = scratch_folder(s.spark, "landing")
    writers = {
        "financial_transactions": transactions_csv, "product_reviews": reviews_tsv,
        "inventory": inventory_json, "store_locations": stores_json,
    }

    def job(table):
        path = f"{folder}/{table.file}"
        if table.name in PLANTED:
            return lambda: table_csv(s, table.name, path)
        return lambda: writers[table.name](s, path)

    run_together(s.spark, map(job, TABLES.values()))
    return folder


# Files repeat their field names and values, and are read by one task each once compressed, hence their bound
COMPRESSED = {"compression": "gzip", "maxRecordsPerFile": "1000000"}
# a level below gzip's default lines take a fifth less time to write, for 1 to 5 % more bytes; objects would grow by 11 %
COMPRESSED_LINES = COMPRESSED | {"zlib.compress.level": "FIVE"}


def _write_lines(
    spark: SparkSession, lines: DataFrame, header: str, purpose: str, folder: str | None = None, compressed=COMPRESSED_LINES
) -> str:
    """One text column as raw lines, each part file starting with ``header``."""
    folder = folder or scratch_folder(spark, purpose)
    # a one-column CSV without quoting or usable separator is plain lines with a header
    lines.toDF(header).write.option("header", True).option("quote", "").option("sep", "\u0001").option(
        "emptyValue", ""
    ).options(**compressed).csv(folder)
    return folder


def transactions_csv(s: StarSchema, folder: str | None = None) -> str:
    table = TABLES["financial_transactions"]
    fault = "CAST(transaction_id AS BIGINT) % 50"
    fields = [
        f"CASE WHEN {fault} = 13 THEN '  ' ELSE concat(' ', transaction_id, ' ') END",
        f"CASE WHEN {fault} = 11 THEN '1995-13-01' ELSE CAST(transaction_date AS STRING) END",
        "transaction_type",
        f"CASE WHEN {fault} = 7 THEN 'bad' ELSE CAST(amount AS STRING) END",
        "payment_method",
        "concat('\"', entity, ', Ltd\"')",
        "region",
        f"CASE {fault} WHEN 17 THEN repeat('x', 51) WHEN 23 THEN 'NULL' ELSE account_code END",
    ]
    line = f"concat(concat_ws(',', {', '.join(fields)}), CASE WHEN {fault} = 19 THEN ',extra' ELSE '' END)"
    lines = s.bronze(table.name).selectExpr(line)
    return _write_lines(s.spark, lines, ",".join(table.names), "transactions-csv", folder)


def numbered_csv(s: StarSchema) -> str:
    """Transactions, some with a bad amount or too many fields; each names its own part file and place in it."""
    table = TABLES["financial_transactions"]
    at = "concat('#', spark_partition_id(), ':', (monotonically_increasing_id() & 8589934591) + 1, '#')"
    fault = "CAST(transaction_id AS BIGINT) % 50"
    spoilt = {"payment_method": at, "amount": f"CASE WHEN {fault} IN (7, 8) THEN 'bad' ELSE CAST(amount AS STRING) END"}
    fields = ", ".join(f"coalesce({spoilt.get(c, f'CAST({c} AS STRING)')}, '')" for c in table.names)
    line = f"concat(concat_ws(',', {fields}), CASE WHEN {fault} = 19 THEN ',extra' ELSE '' END)"
    # places are told from bytes of splits, which compressed files do not have
    lines = s.bronze(table.name).selectExpr(line)
    return _write_lines(s.spark, lines, ",".join(table.names), "numbered-csv", compressed={})


def reviews_tsv(s: StarSchema, folder: str | None = None) -> str:
    table = TABLES["product_reviews"]
    fields = [
        "CASE review_id % 40 WHEN 7 THEN 'zz' WHEN 11 THEN repeat('9', 20) ELSE CAST(review_id AS STRING) END",
        "product_id", "reviewer_id", "reviewer_name",
        "CASE review_id % 40 WHEN 3 THEN '4.5' WHEN 5 THEN 'abc' ELSE CAST(rating AS STRING) END",
        "CASE WHEN review_id % 40 = 1 THEN 'yesterday' ELSE concat(CAST(review_date AS STRING), ' 08:15:00') END",
        "review_title", "review_text",
    ]
    # some rows end one field short, the others one field long
    line = (
        f"concat(concat_ws('\\t', {', '.join(fields)}), "
        "CASE WHEN review_id % 40 = 9 THEN '' ELSE concat('\\t', product_category, '\\tsurplus') END)"
    )
    lines = s.bronze(table.name).selectExpr(line)
    return _write_lines(s.spark, lines, "\t".join(table.names), "reviews-tsv", folder)


def inventory_json(s: StarSchema, folder: str | None = None) -> str:
    """One object per line; stock is text, no number or too large in some rows; some lines break off."""
    stock = (
        F.when((F.col("reorder_point") == 35) & (F.col("lead_time") == 29), F.lit("bad"))
        .when((F.col("reorder_point") == 30) & (F.col("lead_time") == 11), F.lit("9" * 20))
        .otherwise(F.col("current_stock").cast("string"))
    )
    rows = s.bronze("inventory")
    return _write_objects(s.spark, rows.withColumn("current_stock", stock), F.col("lead_time") == 17, "inventory-json", folder)


# elements of an array file
ELEMENTS = 500


def inventory_arrays(s: StarSchema) -> str:
    """Files that are arrays of objects over several lines; some elements break off or are no objects."""
    rows = s.bronze("inventory")
    line = F.to_json(F.struct(*rows.columns))
    element = (
        F.when(F.col("lead_time") == 17, F.regexp_replace(line, ",", " "))
        .when(F.col("lead_time") == 11, F.substring(line, 1, 40))
        .when((F.col("reorder_point") == 35) & (F.col("lead_time") == 29), F.regexp_replace(line, '"current_stock":[0-9-]+', '"current_stock":"bad"'))
        .otherwise(line)
    )
    arrays = rows.count() // ELEMENTS + 1
    held = rows.select(element.alias("element"), F.pmod(F.xxhash64(*rows.columns), F.lit(arrays)).alias("array"))
    # about ELEMENTS elements to an array
    text = held.groupBy("array").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("element"), ",\n"), F.lit("\n]")).alias("value"))
    folder = scratch_folder(s.spark, "inventory-arrays")
    # tasks put their many files in place themselves; the driver would rename one after the other
    text.select("value").write.options(
        **{"maxRecordsPerFile": 1, "mapreduce.fileoutputcommitter.algorithm.version": 2}
    ).text(folder)
    return folder


def _write_objects(spark: SparkSession, rows: DataFrame, broken, purpose: str, folder: str | None = None) -> str:
    """One object per line; where ``broken`` holds, without its last character."""
    line = F.to_json(F.struct(*rows.columns))
    folder = folder or scratch_folder(spark, purpose)
    rows.select(F.when(broken, line.substr(F.lit(1), F.length(line) - 1)).otherwise(line)).write.options(**COMPRESSED).text(folder)
    return folder


def stores_json(s: StarSchema, folder: str | None = None) -> str:
    """One object per line; postal codes are numbers; some lines break off."""
    rows = s.bronze("store_locations").withColumn("postal_code", F.col("postal_code").cast("bigint"))
    return _write_objects(s.spark, rows, F.col("employee_count") % 10 == 7, "stores-json", folder)
