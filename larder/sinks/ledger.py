"""Loads that may be repeated: tables whose partitions are load batches.

A batch has an id of the caller's choice, a day or a file's name or the id of a
stream's micro-batch. Its accepted rows are one partition of a table and its
rejected rows one partition of another. Storing the same batch again replaces
those partitions and nothing else, so a job that died half-way is simply run
again. Partitions are written aside and moved into place when the write is done.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from larder.schemas import TABLES, Table
from larder.sinks.tables import ONLY_WRITTEN, _quoted, document
from larder.sources import files

BATCH = "load_batch"
REJECTS = f"raw string, {files.ERRORS} array<string>"


@dataclass(frozen=True)
class Ledger:
    """Names of the two tables of a raw table's loads."""

    table: Table
    good: str
    rejects: str


def create_ledger(spark: SparkSession, table: Table | str, database: str) -> Ledger:
    """The two empty tables of a raw table's loads, where absent."""
    table = TABLES[table] if isinstance(table, str) else table
    ledger = Ledger(table, f"{database}.{table.name}_loads", f"{database}.{table.name}_load_rejects")
    for name, schema in ((ledger.good, table.schema), (ledger.rejects, REJECTS)):
        if not spark.catalog.tableExists(name):
            empty = spark.createDataFrame([], schema).withColumn(BATCH, F.lit("").cast("string"))
            empty.write.format("parquet").options(**ONLY_WRITTEN).partitionBy(BATCH).saveAsTable(name)
    document(spark, ledger.good, f"{table.comment or table.name}, one partition for each load", {})
    document(spark, ledger.rejects, f"Rows that loads of {table.name} did not take, and why", {})
    return ledger


def put_batch(rows: DataFrame, target: str, batch: str) -> int:
    """Make ``rows`` the partition ``batch`` of ``target``, whatever it held before; how many there are."""
    spark = rows.sparkSession
    columns = [c for c in spark.table(target).columns if c != BATCH]
    held = Observation()
    marked = rows.select(*columns).observe(held, F.count("*").alias("n")).withColumn(BATCH, F.lit(batch))
    marked.write.mode("overwrite").insertInto(target)
    n = held.get["n"]
    if not n:  # no rows name no partition, so the old one is still there
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({BATCH} = {_quoted(batch)})")
    spark.catalog.refreshTable(target)
    return n


def load_batch(spark: SparkSession, path: str, ledger: Ledger, batch: str, **options) -> tuple[int, int]:
    """Load a file or folder as one batch: numbers of accepted and rejected rows."""
    loaded = files.load(spark, path, ledger.table, **options)
    return put_batch(loaded.good, ledger.good, batch), put_batch(loaded.rejects, ledger.rejects, batch)


def batch_rows(spark: SparkSession, ledger: Ledger, batch: str) -> DataFrame:
    """The accepted rows of one batch; no other partition is opened."""
    return spark.table(ledger.good).where(F.col(BATCH) == batch).drop(BATCH)


def load_history(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """load_batch, loaded_rows, rejected_rows for every batch that stored any row."""
    sides = [
        spark.table(name).groupBy(BATCH).agg(F.count("*").alias("n")).select(BATCH, *counts)
        for name, counts in (
            (ledger.good, (F.col("n").alias("loaded"), F.lit(0).alias("rejected"))),
            (ledger.rejects, (F.lit(0).alias("loaded"), F.col("n").alias("rejected"))),
        )
    ]
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy(BATCH)
        .agg(F.sum("loaded").alias("loaded_rows"), F.sum("rejected").alias("rejected_rows"))
        .orderBy(BATCH)
    )
