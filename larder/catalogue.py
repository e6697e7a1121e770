"""Named queries over a star-schema folder: ``QUERIES[name](spark, folder)``.

Called with a folder, an entry reads whole raw tables, cleans what it needs and
runs one report, as one lazy plan. Where the clean layer is stored,
``QUERIES[name].on(table)`` runs the same report over the stored tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.operators.clean import CLEANINGS, clean_keys
from larder.plans import customers, gold, logistics, marketing, promotions, quality, reviews, rollups, sales, service
from larder.plans import layers as batch
from larder.schemas import TABLES
from larder.session import remove_folder, scratch_folder
from larder.sinks import ledger, merges, tables as sink
from larder.sinks.exports import PROMOTION_EXPORTS, SALES_EXPORTS, export_csv
from larder.sinks.tables import Layers
from larder.sources import files, landing
from larder.sources.star_schema import StarSchema
from larder.streaming.incremental import load_new_files

Query = Callable[[SparkSession, str], DataFrame]

# the reference day of reports that would otherwise depend on today
AS_OF = "2002-01-01"

SOME_SALES = {
    "regions": ["ASIA", "EUROPE", "MIDDLE EAST"],
    "methods": ["1-URGENT", "2-HIGH", "5-LOW"],
    "min_amount": 1000,
}
SOME_REGIONS = ["ASIA", "EUROPE", "MIDDLE EAST"]
SOME_CATEGORIES = ["Brand#1", "Brand#2", "Brand#3", "Brand#10", "Brand#17"]
SOME_TYPES = ["ECONOMY", "SMALL", "PROMO"]
SOME_DISCOUNTS = promotions.percent_range(5, 40)


# table -> date column of its period, for the overview
PERIODS = {
    "customer_demographics": "date_of_birth",
    "customer_service_interactions": "interaction_date",
    "financial_transactions": "transaction_date",
    "promotions_data": "start_date",
    "marketing_campaigns": "start_date",
    "product_reviews": "review_date",
    "logistics_and_shipping": "ship_date",
    "supplier_information": None,
    "employee_records": "hire_date",
    "inventory": "last_restock_date",
    "store_locations": None,
}


@dataclass(frozen=True)
class Report:
    """A report and the clean tables it reads, named after their raw tables."""

    tables: tuple[str, ...]
    run: Callable[..., DataFrame]

    def on(self, clean_table: Callable[[str], DataFrame]) -> DataFrame:
        """Run over tables from anywhere: a catalog, a folder, test frames."""
        return self.run(*map(clean_table, self.tables))

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.on(StarSchema(spark, folder).silver)


def _over(*tables: str) -> Callable[[Callable[..., DataFrame]], Report]:
    return lambda run: Report(tables, run)


_tx = _over("financial_transactions")
_customers = _over("customer_demographics")
_service = _over("customer_service_interactions")
_promos = _over("promotions_data")
_campaigns = _over("marketing_campaigns")
_reviews = _over("product_reviews")
_shipments = _over("logistics_and_shipping")
_stock = _over("inventory")
_tx_promos = _over("financial_transactions", "promotions_data")
_campaigns_tx = _over("marketing_campaigns", "financial_transactions")


def _stage(report: Callable[[StarSchema], DataFrame]) -> Query:
    return lambda spark, folder: report(StarSchema(spark, folder))


def _export(table: str, report: Callable[[DataFrame], DataFrame], name: str) -> Query:
    """A dashboard table written as CSV and read back as text."""

    def run(s: StarSchema) -> DataFrame:
        rows = report(s.silver(table))
        target = export_csv(rows, scratch_folder(s.spark, "export"), name)
        schema = ", ".join(f"{c} string" for c in rows.columns)
        return s.spark.read.option("header", True).schema(schema).csv(target)

    return _stage(run)


def _reject_reasons(landed: Callable[[StarSchema], str], table: str) -> Query:
    """How many rows of a landing file are rejected for which reason, whatever file they are in."""

    def run(s: StarSchema) -> DataFrame:
        rejects = files.validate_load(s.spark, landed(s), table).select(F.explode(files.ERRORS).alias("reason"))
        reason = F.regexp_replace("reason", "^(not valid JSON).*", "$1")
        return rejects.withColumn("reason", reason).groupBy("reason").agg(F.count("*").alias("nb_rows"))

    return _stage(run)


def _reconciled(landed: Callable[[StarSchema], str], table: str) -> Query:
    def run(s: StarSchema) -> DataFrame:
        path = landed(s)
        return files.reconcile_load(s.spark, path, table, files.load(s.spark, path, table).good)

    return _stage(run)


def _own_layers(s: StarSchema) -> Layers:
    """Layer databases of this run alone, stored in the shared scratch folder."""
    location = scratch_folder(s.spark, "lake")
    run = location.rsplit("-", 1)[1]
    layers = Layers(*(f"{layer}_{run}" for layer in ("bronze", "silver", "analytics")))
    sink.ensure_layers(s.spark, layers, location)
    return layers


def _and_gone(s: StarSchema, layers: Layers, found: DataFrame) -> DataFrame:
    """The few rows of a report about layers of this run, which are then deleted."""
    rows = s.spark.createDataFrame(found.collect(), found.schema)
    for database in (layers.bronze, layers.silver, layers.analytics):
        s.spark.sql(f"DROP SCHEMA {database} CASCADE")
    return rows


def _batch(s: StarSchema) -> DataFrame:
    """The whole batch from landing files into stored tables, then what they hold."""
    folder, layers = landing.whole_landing(s), _own_layers(s)
    sink.create_bronze(s.spark, layers.bronze)
    batch.load_bronze(s.spark, folder, layers)
    batch.build_silver(s.spark, layers)
    batch.build_gold(s.spark, layers, AS_OF)
    # one row for each table
    found = _and_gone(s, layers, batch.lake_inventory(s.spark, layers))
    remove_folder(s.spark, folder)
    return found


def _environment(s: StarSchema) -> DataFrame:
    """What the catalog says of layers just built from landing files, and what the stage and a look into it show."""
    folder, layers = landing.whole_landing(s), _own_layers(s)
    sink.create_bronze(s.spark, layers.bronze)
    batch.load_bronze(s.spark, folder, layers)
    status = sink.environment_status(s.spark, layers).first()
    stores = files.preview_file(s.spark, f"{folder}/{TABLES['store_locations'].file}", "store_locations").collect()
    stores = s.spark.createDataFrame(stores, TABLES["store_locations"].text_schema)
    known = s.bronze("store_locations").select("store_id")
    listed = files.list_stage(s.spark, folder).where("length > 0 AND path LIKE '%/part-%'")
    commented = s.spark.catalog.getTable(f"{layers.bronze}.inventory").description
    rows = [
        ("status", status["status"], status["nb_tables"]),
        ("layers", status["schemas_info"].replace(layers.bronze, "bronze").replace(layers.silver, "silver"), 2),
        ("catalog", status["database_info"], 1),
        ("tables", None, sink.list_tables(s.spark, layers.bronze).count()),
        ("inventory", commented, sink.read_table(s.spark, f"{layers.bronze}.inventory").count()),
        ("stage", None, listed.select(F.regexp_extract("path", "/([^/]+)/part-", 1)).distinct().count()),
        # records that do not parse show no fields
        ("preview", None, stores.count() - stores.where("store_id IS NOT NULL").join(known, "store_id", "left_anti").count()),
    ]
    # seven rows about the environment
    found = s.spark.createDataFrame(rows, "item string, text string, nb bigint")
    found = _and_gone(s, layers, found)
    remove_folder(s.spark, folder)
    return found


def _loaded_once(s: StarSchema) -> DataFrame:
    """The landing folder loaded twice through the incremental load: every file counts once."""
    folder = landing.transactions_csv(s)
    book = ledger.create_ledger(s.spark, "financial_transactions", _own_layers(s).bronze)
    state = scratch_folder(s.spark, "load-state")
    for _ in range(2):
        load_new_files(s.spark, folder, "financial_transactions", book, state).awaitTermination()
    for used in (folder, state):
        remove_folder(s.spark, used)
    return s.spark.table(book.good).drop(ledger.BATCH)


def _merged_batches(s: StarSchema) -> DataFrame:
    """Stock levels in three batches through ledger and merges, one batch stored and merged twice."""
    layers, rows = _own_layers(s), s.bronze("inventory")
    book = ledger.create_ledger(s.spark, "inventory", layers.bronze)
    target = merges.create_mergeable(s.spark, "inventory", layers.silver, parts=16)
    third = F.pmod(F.xxhash64(*rows.columns), F.lit(3))
    for k in (0, 1, 1, 2):
        ledger.put_batch(rows.where(third == k), book.good, f"batch-{k}")
        merges.merge_clean(s.spark, "inventory", ledger.batch_rows(s.spark, book, f"batch-{k}"), target)
    s.spark.sql(f"DROP SCHEMA {layers.bronze} CASCADE")
    return merges.clean_rows(s.spark, target)


def _layer_checks(s: StarSchema) -> DataFrame:
    """What the raw rows broke, as recorded by the pass that cleaned them."""
    layers = _own_layers(s)
    batch.run_together(
        s.spark, [lambda t=t: sink.materialize(s.bronze(t), f"{layers.bronze}.{t}") for t in TABLES]
    )
    batch.build_silver_checked(s.spark, layers)
    # one row for each table
    return _and_gone(s, layers, s.spark.table(f"{layers.analytics}.{batch.CHECKS}"))


def _rolled_up(s: StarSchema) -> DataFrame:
    """Four sales reports from a roll-up kept through merges: a third of the sales come with other amounts, then mended."""
    layers, rows = _own_layers(s), s.bronze("financial_transactions")
    target = merges.create_mergeable(s.spark, "financial_transactions", layers.silver, parts=16)
    rollup = f"{layers.analytics}.daily_sales"
    third = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    # of two rows of a key the clean layer keeps the lesser
    other = rows.where(third == 1).withColumn("amount", (F.col("amount") + 1_000_000).cast("decimal(18,2)"))
    for batch_rows in (rows.where(third == 0).unionByName(other), rows.where(third != 0), rows.where(third == 2)):
        refreshed = merges.merge_clean(s.spark, "financial_transactions", batch_rows, target)
        rollups.refresh_rollup(s.spark, target, rollup, refreshed)
    daily = s.spark.table(rollup)
    reports = {
        "month": (rollups.monthly_sales(daily), "month", "avg_transaction_value"),
        "quarter": (rollups.quarterly_sales(daily), "quarter", "avg_transaction_value"),
        "weekday": (rollups.weekday_sales(daily), "day_of_week", "avg_transaction_value"),
        "region": (rollups.region_sales(daily), "region", "avg_transaction"),
    }
    s.spark.sql(f"DROP SCHEMA {layers.silver} CASCADE")
    return reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(name).alias("report"), F.col(label).cast("string").alias("label"), "nb_transactions", "total_sales", F.col(average).alias("average"))
            for name, (df, label, average) in reports.items()
        ],
    )


def _located(s: StarSchema) -> DataFrame:
    """Rejected rows by reason, and how many were found at the record of the file that they name."""
    found = files.validate_located(s.spark, landing.numbered_csv(s), "financial_transactions")
    named = [F.regexp_extract("raw", "#(\\d+):(\\d+)#", k).cast("bigint") for k in (1, 2)]
    file = F.regexp_extract("file", r"part-(\d+)", 1).cast("bigint")
    return found.select(F.explode(files.ERRORS).alias("reason"), ((named[0] == file) & (named[1] == F.col("record"))).alias("there")).groupBy(
        "reason"
    ).agg(F.count("*").alias("nb_rows"), F.count_if("there").alias("nb_located"))


def _elements(s: StarSchema) -> files.Loaded:
    return files.load_json_elements(s.spark, landing.inventory_arrays(s), "inventory")


def _element_reasons(s: StarSchema) -> DataFrame:
    return _elements(s).rejects.select(F.explode(files.ERRORS).alias("e")).select(
        F.regexp_replace("e", "^(not valid JSON).*", "$1").alias("reason")
    ).groupBy("reason").agg(F.count("*").alias("nb_rows"))


def _csv_load(table: str) -> Query:
    return _stage(lambda s: files.load_csv(s.spark, landing.table_csv(s, table), table).good)


def _reconciled_landing(s: StarSchema) -> DataFrame:
    """Records, stored rows and rejects of every landing file."""
    folder = landing.whole_landing(s)

    def one(table) -> DataFrame:
        path = f"{folder}/{table.file}"
        found = files.reconcile_load(s.spark, path, table, files.load(s.spark, path, table).good)
        return found.select(F.lit(table.name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, map(one, TABLES.values())).orderBy("table_name")


def _overview(s: StarSchema) -> DataFrame:
    return quality.table_overview(
        {t: (s.bronze(t), day, CLEANINGS[t].key) for t, day in PERIODS.items()}
    )


def _monthly(tx: DataFrame) -> DataFrame:
    return sales.filtered_monthly_sales(tx)


def _dashboard(limit: int | None = 50):
    return lambda mc, tx: marketing.campaign_dashboard(mc, tx, limit)


QUERIES: dict[str, Query] = {
    # clean tables
    **{f"clean_{t}": _over(t)(lambda df: df) for t in TABLES},
    # sales
    "monthly_sales_mom": _tx(sales.monthly_sales_mom),
    "quarterly_sales": _tx(sales.quarterly_sales),
    "weekday_sales": _tx(sales.weekday_sales),
    "region_sales_share": _tx(sales.region_sales_share),
    # reviews
    "top_categories_by_reviews": _reviews(reviews.top_categories_by_reviews),
    "top_products_by_reviews": _reviews(reviews.top_products_by_reviews),
    "rating_category_distribution": _reviews(reviews.rating_category_distribution),
    # customers
    "age_group_distribution": _customers(lambda c: customers.age_group_distribution(c, AS_OF)),
    "income_bracket_distribution": _customers(customers.income_bracket_distribution),
    "region_gender_distribution": _customers(customers.region_gender_distribution),
    # promotions
    "promo_impact": _tx_promos(promotions.promo_impact),
    "category_promo_sensitivity": _promos(promotions.category_promo_sensitivity),
    "discount_band_distribution": _promos(promotions.discount_band_distribution),
    # marketing
    "campaign_roi_top20": _campaigns_tx(marketing.campaign_roi),
    "campaign_type_performance": _campaigns(marketing.campaign_type_performance),
    "audience_performance": _campaigns(marketing.audience_performance),
    # service
    "service_satisfaction": _service(service.service_satisfaction),
    "duration_bucket_satisfaction": _service(service.duration_bucket_satisfaction),
    # stock and shipping
    "stock_status": _stock(logistics.stock_status),
    "low_stock_by_category": _stock(logistics.low_stock_by_category),
    "stockouts_by_warehouse": _stock(logistics.stockouts_by_warehouse),
    "shipping_method_delay": _shipments(logistics.shipping_method_delay),
    "region_logistics": _shipments(logistics.region_logistics),
    "long_delivery_rate": _shipments(logistics.long_delivery_rate),
    # gold tables
    "enriched_sales": _tx(gold.enriched_sales),
    "promotion_activity": _promos(lambda p: gold.promotion_activity(p, AS_OF)),
    "promotion_activity_today": _promos(gold.promotion_activity),
    "enriched_customers": _customers(lambda c: gold.enriched_customers(c, AS_OF)),
    # quality
    "sales_uniqueness_check": _tx(lambda t: quality.uniqueness_check(gold.enriched_sales(t), "transaction_id")),
    "customers_uniqueness_check": _customers(
        lambda c: quality.uniqueness_check(gold.enriched_customers(c, AS_OF), "customer_id")
    ),
    "negative_amount_check": _tx(lambda t: quality.negative_amount_check(gold.enriched_sales(t))),
    "age_bounds_check": _customers(lambda c: quality.age_bounds_check(gold.enriched_customers(c, AS_OF))),
    "bronze_volumes": _stage(lambda s: quality.volumes({t: s.bronze(t) for t in TABLES})),
    "silver_volumes": _stage(
        lambda s: quality.volumes({c.target: clean_keys(s.bronze(t), t) for t, c in CLEANINGS.items()})
    ),
    "inventory_uniqueness_check": _stage(
        lambda s: quality.uniqueness_check(s.bronze("inventory"), *CLEANINGS["inventory"].key)
    ),
    "layer_checks": _stage(_layer_checks),
    "sales_row_count": _tx(lambda t: quality.row_count(gold.enriched_sales(t))),
    "reviews_row_count": _stage(lambda s: quality.row_count(s.bronze("product_reviews"), "rows_reviews")),
    "sample_promotions": _stage(lambda s: quality.sample_rows(s.bronze("promotions_data"), ["promotion_id"])),
    "sample_gold_sales": _tx(lambda t: quality.sample_rows(gold.enriched_sales(t), ["transaction_id"])),
    # sales dashboard
    "sales_regions": _tx(sales.sales_regions),
    "sales_payment_methods": _tx(sales.sales_payment_methods),
    "filtered_monthly_sales": _tx(lambda t: sales.filtered_monthly_sales(t, **SOME_SALES)),
    "filtered_region_sales": _tx(lambda t: sales.filtered_region_sales(t, **SOME_SALES)),
    "filtered_weekday_sales": _tx(lambda t: sales.filtered_weekday_sales(t, **SOME_SALES)),
    "sales_kpis": _tx(lambda t: sales.sales_kpis(_monthly(t))),
    "best_month": _tx(lambda t: sales.best_month(_monthly(t))),
    "monthly_rollup_all_regions": _tx(lambda t: sales.monthly_rollup_all_regions(_monthly(t))),
    "monthly_for_region": _tx(lambda t: sales.monthly_for_region(_monthly(t), "ASIA")),
    "weekday_rollup_all_regions": _tx(lambda t: sales.weekday_rollup_all_regions(sales.filtered_weekday_sales(t))),
    "weekday_for_region": _tx(lambda t: sales.weekday_for_region(sales.filtered_weekday_sales(t), "ASIA")),
    "monthly_detail": _tx(lambda t: sales.monthly_detail(_monthly(t))),
    "weekday_detail": _tx(lambda t: sales.weekday_detail(sales.filtered_weekday_sales(t))),
    "top3_regions": _tx(lambda t: sales.top_regions(sales.filtered_region_sales(t))),
    "sales_filter_summary": _tx(sales.sales_filter_summary),
    # marketing dashboard
    "campaign_roi_top50": _campaigns_tx(_dashboard()),
    "campaign_type_table": _campaigns(marketing.campaign_type_table),
    "audience_table": _campaigns(marketing.audience_table),
    "marketing_kpis": _campaigns_tx(lambda mc, tx: marketing.marketing_kpis(_dashboard(None)(mc, tx))),
    "top10_campaigns": _campaigns_tx(lambda mc, tx: marketing.top_campaigns(_dashboard()(mc, tx))),
    "top3_campaigns": _campaigns_tx(lambda mc, tx: marketing.top_campaigns(_dashboard()(mc, tx), 3)),
    "best_campaign_type": _campaigns(lambda mc: marketing.best_campaign_type(marketing.campaign_type_table(mc))),
    "low_roi_alert": _campaigns_tx(lambda mc, tx: marketing.low_roi_alert(_dashboard(None)(mc, tx))),
    # promotion dashboard
    "promo_regions": _promos(promotions.promo_regions),
    "promo_categories": _promos(promotions.promo_categories),
    "promo_types": _promos(promotions.promo_types),
    "filtered_promo_impact": _tx_promos(
        lambda t, p: promotions.filtered_promo_impact(t, p, SOME_REGIONS, SOME_CATEGORIES, *SOME_DISCOUNTS)
    ),
    "category_sensitivity": _promos(
        lambda p: promotions.category_sensitivity(p, SOME_REGIONS, SOME_CATEGORIES, SOME_TYPES, *SOME_DISCOUNTS)
    ),
    "discount_ranges": _promos(
        lambda p: promotions.discount_ranges(p, SOME_REGIONS, SOME_CATEGORIES, SOME_TYPES)
    ),
    "promo_by_region": _promos(
        lambda p: promotions.promo_by_region(p, SOME_REGIONS, SOME_CATEGORIES, SOME_TYPES, *SOME_DISCOUNTS)
    ),
    "promo_uplift": _tx_promos(lambda t, p: promotions.promo_uplift(promotions.filtered_promo_impact(t, p))),
    "top3_promo_regions": _promos(lambda p: promotions.top_promo_regions(promotions.promo_by_region(p))),
    "category_rollup": _promos(lambda p: promotions.category_rollup(promotions.category_sensitivity(p))),
    "category_rollup_one_region": _promos(
        lambda p: promotions.category_rollup(promotions.category_sensitivity(p), "ASIA")
    ),
    "top_category": _promos(
        lambda p: promotions.top_category(promotions.category_rollup(promotions.category_sensitivity(p)))
    ),
    "margin_alert": _promos(lambda p: promotions.margin_alert(promotions.category_sensitivity(p))),
    "duration_alert": _promos(lambda p: promotions.duration_alert(promotions.category_sensitivity(p))),
    "category_detail": _promos(lambda p: promotions.category_detail(promotions.category_sensitivity(p))),
    "promo_region_detail": _promos(lambda p: promotions.region_detail(promotions.promo_by_region(p))),
    "promo_filter_summary": _promos(promotions.promo_filter_summary),
    # profiles and analyses known by description only
    "table_overview": _stage(_overview),
    "missing_values_profile": _stage(lambda s: quality.missing_values_profile({t: s.bronze(t) for t in TABLES})),
    "customer_dimension_distribution": _customers(
        lambda c: quality.dimension_distribution(
            c.withColumn("birth_year", F.year("date_of_birth")), ["region", "country", "gender", "birth_year"]
        )
    ),
    "sales_dimension_distribution": _tx(
        lambda t: quality.dimension_distribution(
            t.withColumn("month", F.date_format("transaction_date", "yyyy-MM")),
            ["region", "account_code", "transaction_type", "month"],
        )
    ),
    "rating_distribution": _reviews(reviews.rating_distribution),
    "duration_satisfaction_correlation": _service(service.duration_satisfaction_correlation),
    "carrier_cost_comparison": _shipments(logistics.carrier_cost_comparison),
    "delivery_by_method_region": _shipments(logistics.delivery_by_method_region),
    "discount_elasticity_by_category": _tx_promos(promotions.discount_elasticity_by_category),
    "review_volume_vs_rating": _reviews(reviews.review_volume_vs_rating),
    "customer_geography": _customers(customers.customer_geography),
    # landing files, written from the tables with planted faults and loaded back
    "load_transactions_csv": _stage(
        lambda s: files.load_csv(s.spark, landing.transactions_csv(s), "financial_transactions").good
    ),
    "load_transactions_rejects": _reject_reasons(landing.transactions_csv, "financial_transactions"),
    "reconcile_transactions_load": _reconciled(landing.transactions_csv, "financial_transactions"),
    "load_reviews_tsv": _stage(lambda s: files.load_reviews_tsv(s.spark, landing.reviews_tsv(s)).good),
    "load_inventory_json": _stage(
        lambda s: files.load_json(s.spark, landing.inventory_json(s), "inventory").good
    ),
    "load_inventory_rejects": _reject_reasons(landing.inventory_json, "inventory"),
    "reconcile_inventory_load": _reconciled(landing.inventory_json, "inventory"),
    "load_stores_json": _stage(
        lambda s: files.load_json(s.spark, landing.stores_json(s), "store_locations").good
    ),
    "load_stores_rejects": _reject_reasons(landing.stores_json, "store_locations"),
    "reconcile_stores_load": _reconciled(landing.stores_json, "store_locations"),
    "load_transactions_rejects_located": _stage(_located),
    "load_inventory_json_array": _stage(lambda s: _elements(s).good),
    "load_inventory_array_rejects": _stage(_element_reasons),
    "load_customers_csv": _csv_load("customer_demographics"),
    "load_service_csv": _csv_load("customer_service_interactions"),
    "load_promotions_csv": _csv_load("promotions_data"),
    "load_campaigns_csv": _csv_load("marketing_campaigns"),
    "load_shipments_csv": _csv_load("logistics_and_shipping"),
    "load_suppliers_csv": _csv_load("supplier_information"),
    "load_employees_csv": _csv_load("employee_records"),
    "load_shipments_rejects": _reject_reasons(lambda s: landing.table_csv(s, "logistics_and_shipping"), "logistics_and_shipping"),
    "load_suppliers_rejects": _reject_reasons(lambda s: landing.table_csv(s, "supplier_information"), "supplier_information"),
    "reconcile_landing": _stage(_reconciled_landing),
    "load_transactions_incremental": _stage(_loaded_once),
    "clean_incremental": _stage(_merged_batches),
    "sales_from_rollup": _stage(_rolled_up),
    "export_region_sales_csv": _export("financial_transactions", sales.filtered_region_sales, SALES_EXPORTS["regions"]),
    "export_monthly_sales_csv": _export("financial_transactions", sales.filtered_monthly_sales, SALES_EXPORTS["monthly"]),
    "export_weekday_sales_csv": _export("financial_transactions", sales.filtered_weekday_sales, SALES_EXPORTS["weekdays"]),
    "export_promo_categories_csv": _export("promotions_data", promotions.category_sensitivity, PROMOTION_EXPORTS["categories"]),
    "export_promo_regions_csv": _export("promotions_data", promotions.promo_by_region, PROMOTION_EXPORTS["regions"]),
    "export_promo_discounts_csv": _export(
        "promotions_data",
        lambda p: promotions.discount_ranges(p, SOME_REGIONS, SOME_CATEGORIES, SOME_TYPES),
        PROMOTION_EXPORTS["discounts"],
    ),
    # the batch into catalog tables
    "stored_layers": _stage(_batch),
    "environment_report": _stage(_environment),
}
