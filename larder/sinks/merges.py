"""Clean tables kept up to date batch by batch.

Of the rows of a key the clean layer keeps the first in a fixed order, so the
winner of all rows is the winner of earlier winners and new rows: merging
batches in any order, any of them twice, ends in the table that a rebuild from
all raw rows gives.

A clean table that takes merges is partitioned by a function of its key. A batch
reads and replaces only the partitions its keys fall in. Neighbouring keys share
a partition, as a key's last characters do not count, so a feed whose keys
ascend touches few of them; late duplicates add theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from larder.operators.clean import CLEANINGS, apply_rules, keep_one, laid_out
from larder.schemas import TABLES
from larder.sinks.tables import ONLY_WRITTEN, declare_key, declared_property, document, set_property

PART = "key_part"
PARTS = 256
# characters at the end of a key that do not decide on its partition
NEAR = 3
PARTS_PROPERTY = "larder.key_parts"


def key_part(key: tuple[str, ...], parts: int) -> Column:
    """Partition of a cleaned row. A NULL in the key is a value like others."""
    texts = [F.col(c).cast("string") for c in key]
    if len(texts) == 1:
        texts = [F.substring(texts[0], 1, F.greatest(F.length(texts[0]) - NEAR, F.lit(0)))]
    return F.pmod(F.xxhash64(*texts), F.lit(parts)).cast("int")


def create_mergeable(spark: SparkSession, raw: str, database: str, parts: int = PARTS) -> str:
    """An empty clean table that takes merges, where absent."""
    spec = CLEANINGS[raw]
    name = f"{database}.{spec.target}"
    if not spark.catalog.tableExists(name):
        empty = spark.createDataFrame([], TABLES[raw].schema).withColumn(PART, F.lit(0))
        empty.write.format("parquet").options(**ONLY_WRITTEN).partitionBy(PART).saveAsTable(name)
        set_property(spark, name, PARTS_PROPERTY, str(parts))
        document(spark, name, f"{TABLES[raw].comment or raw}, one row per key; partitioned by a function of the key", {})
        declare_key(spark, name, spec.key)
    return name


def merge_clean(spark: SparkSession, raw: str, rows: DataFrame, target: str) -> list[int]:
    """Merge raw ``rows`` into the clean table ``target``; the partitions replaced.

    A merge that died is repeated with the same rows. Two merges into one table
    must not run at the same time.
    """
    spec = CLEANINGS[raw]
    part = key_part(spec.key, int(declared_property(spark, target, PARTS_PROPERTY)))
    new = keep_one(apply_rules(rows.select(*TABLES[raw].names), spec), spec.key, spec.newest)
    # at most one row for each partition of the table
    touched = sorted(r[0] for r in apply_rules(rows.select(*TABLES[raw].names), spec).select(part.alias(PART)).distinct().collect())
    if not touched:
        return []
    old = spark.table(target).where(F.col(PART).isin(touched)).drop(PART)
    merged = keep_one(old.unionByName(new), spec.key, spec.newest)
    # rows of one partition come together, large ones are split, before files are written
    placed = merged.withColumn(PART, part).hint("rebalance", PART)
    laid_out(placed, raw).write.mode("overwrite").insertInto(target)
    spark.catalog.refreshTable(target)
    return touched


def clean_rows(spark: SparkSession, target: str) -> DataFrame:
    """The clean table without its partition column."""
    return spark.table(target).drop(PART)
