"""The batch: landing files to raw tables, to clean tables, to gold tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from larder.operators.clean import CLEANINGS, clean, laid_out
from larder.plans import gold, quality
from larder.schemas import TABLES
from larder.sinks import tables as sink
from larder.sinks.tables import Layers
from larder.sources.files import load

# gold table -> (clean source, logical key, table comment, column comments)
GOLD = {
    "ventes_enrichies": (
        "financial_transactions_clean", "transaction_id",
        "One row per sale; rows of other transaction types are not in it",
        {
            "transaction_id": "text key, one row each; NULL at most once",
            "transaction_date": "date; NULL where the source had none, then all calendar columns are NULL",
            "annee": "int, from transaction_date",
            "mois": "int 1-12, from transaction_date",
            "mois_aaaamm": "text yyyy-MM, sorts by time",
            "jour_semaine_iso": "int, weeks start on Monday as 1",
            "is_weekend": "int flag: 1 if jour_semaine_iso is 6 or 7",
            "transaction_type": "text, constant here by the sale filter",
            "amount": "decimal in the currency of the feed; negative amounts became NULL in the clean layer",
            "payment_method": "text as delivered, trimmed",
            "entity": "text as delivered, trimmed",
            "region": "text; joins to promotions, campaigns and customers",
            "account_code": "text as delivered, trimmed",
        },
    ),
    "promotions_actives": (
        "promotions_clean", "promotion_id",
        "One row per promotion, past and future ones too; is_active says whether the reference day lies in it", {},
    ),
    "clients_enrichis": (
        "customer_demographics_clean", "customer_id",
        "One row per customer, segmented on the reference day of the build",
        {
            "customer_id": "bigint key, one row each",
            "name": "text, trimmed",
            "date_of_birth": "date; NULL leaves age and age_segment without a value",
            "age": "int: year of the reference day less year of birth, birthdays not regarded",
            "age_segment": "text, band of age",
            "gender": "text as delivered, trimmed",
            "marital_status": "text as delivered, trimmed",
            "annual_income": "decimal per year; negative values became NULL in the clean layer",
            "income_bracket": "text, band of annual_income",
            "region": "text; joins to sales",
            "country": "text as delivered, trimmed",
            "city": "text as delivered, trimmed",
        },
    ),
}


def run_together(spark: SparkSession, jobs: Iterable[Callable[[], None]], at_once: int = 8) -> None:
    """Run independent table builds side by side, so small tables do not leave the cluster idle.

    The first failure is raised once the running builds have ended.
    """
    with ThreadPoolExecutor(at_once) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for done in waiting:
        done.result()


def load_bronze(spark: SparkSession, folder: str, layers: Layers = Layers(), **options) -> None:
    """Append every landing file to its raw table. Rejected rows are left to ``validate_load``."""

    def job(table):
        loaded = load(spark, f"{folder.rstrip('/')}/{table.file}", table, **options)
        return lambda: sink.append(loaded.good, f"{layers.bronze}.{table.name}")

    run_together(spark, map(job, TABLES.values()))


def build_silver(spark: SparkSession, layers: Layers = Layers()) -> None:
    def job(name, target):
        cleaned = laid_out(clean(spark.table(f"{layers.bronze}.{name}"), name), name)
        return lambda: sink.materialize(cleaned, f"{layers.silver}.{target}")

    run_together(spark, [job(name, spec.target) for name, spec in CLEANINGS.items()])


CHECKS = "layer_checks"
_CHECKED = (
    "table_name string, raw_rows bigint, clean_rows bigint, duplicate_rows bigint, null_key_rows bigint, "
    "negative_values bigint, out_of_range_values bigint, reversed_periods bigint"
)


def build_silver_checked(spark: SparkSession, layers: Layers = Layers()) -> None:
    """``build_silver``, and a table ``layer_checks`` of what the raw rows broke, measured by the pass that cleans them.

    Figures ride along with the write, so no table is read for them. Tasks that
    run again after a lost executor are counted again; the number of raw rows,
    which the stored table knows without a scan, shows that, and the figures of
    that table are then taken by a query of their own.
    """
    found = []

    def job(name, spec):
        raw, target = spark.table(f"{layers.bronze}.{name}"), f"{layers.silver}.{spec.target}"

        def build() -> None:
            before, after = Observation(), Observation()
            checks = quality.raw_checks(spec)
            cleaned = clean(raw.observe(before, *checks), name).observe(after, F.count("*").alias("clean_rows"))
            sink.materialize(laid_out(cleaned, name), target)
            figures = before.get
            if figures["raw_rows"] != raw.count():
                figures = raw.agg(*checks).first().asDict()
            clean_rows = after.get["clean_rows"]
            found.append((name, figures["raw_rows"], clean_rows, figures["raw_rows"] - clean_rows, *(figures[c] for c in _FIGURES)))

        return build

    run_together(spark, [job(name, spec) for name, spec in CLEANINGS.items()])
    sink.materialize(spark.createDataFrame(found, _CHECKED), f"{layers.analytics}.{CHECKS}")


_FIGURES = ("null_key_rows", "negative_values", "out_of_range_values", "reversed_periods")


def gold_table(name: str, source: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    if name == "ventes_enrichies":
        return gold.enriched_sales(source)
    if name == "promotions_actives":
        return gold.promotion_activity(source, as_of)
    if name == "clients_enrichis":
        return gold.enriched_customers(source, as_of)
    raise KeyError(name)


# gold table -> columns its files are partitioned by
GOLD_PARTITIONS = {"ventes_enrichies": ("annee", "mois")}


def build_gold(spark: SparkSession, layers: Layers = Layers(), as_of: dt.date | str | None = None) -> None:
    for name, (source, key, comment, columns) in GOLD.items():
        target = f"{layers.analytics}.{name}"
        rows = gold_table(name, spark.table(f"{layers.silver}.{source}"), as_of)
        parts = GOLD_PARTITIONS.get(name, ())
        for column in parts:  # a partition column takes its comment from the rows, not afterwards
            rows = rows.withMetadata(column, {"comment": columns[column]})
        sink.materialize(rows, target, parts)
        sink.document(spark, target, comment, {c: text for c, text in columns.items() if c not in parts})
        sink.declare_key(spark, target, [key])


def bronze_volumes(spark: SparkSession, layers: Layers = Layers()) -> DataFrame:
    return quality.volumes({n: spark.table(f"{layers.bronze}.{n}") for n in TABLES})


def silver_volumes(spark: SparkSession, layers: Layers = Layers()) -> DataFrame:
    return quality.volumes({c.target: spark.table(f"{layers.silver}.{c.target}") for c in CLEANINGS.values()})


def lake_inventory(spark: SparkSession, layers: Layers = Layers()) -> DataFrame:
    """One row per stored table: its layer, rows, and key figures where a key is declared."""
    tables = [("bronze", layers.bronze, n) for n in TABLES]
    tables += [("silver", layers.silver, c.target) for c in CLEANINGS.values()]
    tables += [("analytics", layers.analytics, n) for n in GOLD]

    def figures(layer: str, database: str, name: str) -> DataFrame:
        table = f"{database}.{name}"
        if sink.declared_key(spark, table):
            found = sink.check_key(spark, table)
        else:
            unknown = F.lit(None).cast("bigint")
            found = quality.row_count(spark.table(table)).select(
                "nb", unknown.alias("nb_distinct"), unknown.alias("nb_null_keys")
            )
        return found.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, [figures(*t) for t in tables]).orderBy("layer", "table_name")
