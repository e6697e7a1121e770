"""Catalog layers: databases, empty typed tables, materialised results, documentation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.schemas import TABLES, Table


@dataclass(frozen=True)
class Layers:
    """Database names of the three layers."""

    bronze: str = "bronze"
    silver: str = "silver"
    analytics: str = "analytics"


LAYER_COMMENTS = {
    "bronze": "Accepted rows of the landing files, typed, nothing else changed; appended to by every load",
    "silver": "One table per raw table: rules applied, one row per key; rebuilt whole",
    "analytics": "Tables computed from the clean layer; rebuilt whole",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# options of a stored table: about a quarter fewer bytes than by default; version 2 writes numbers and texts as differences,
# after which zstd's higher levels save a hundredth and take a third longer
CODEC = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def ensure_layers(spark: SparkSession, layers: Layers = Layers(), location: str | None = None) -> None:
    """Create the three databases where absent, under ``location`` or in the warehouse folder."""
    for layer, comment in LAYER_COMMENTS.items():
        name = getattr(layers, layer)
        place = f" LOCATION {_quoted(f'{location}/{name}')}" if location else ""
        spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:db) COMMENT {_quoted(comment)}{place}", args={"db": name}
        )


def create_table(spark: SparkSession, table: Table, database: str) -> str:
    """An empty typed table, replacing one of the same name."""
    name = f"{database}.{table.name}"
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})
    empty = spark.createDataFrame([], table.schema)
    empty.write.format("parquet").options(**CODEC).saveAsTable(name)
    document(spark, name, table.comment, {})
    if table.primary_key:
        declare_key(spark, name, table.primary_key)
    return name


def create_bronze(spark: SparkSession, database: str = "bronze") -> list[str]:
    return [create_table(spark, t, database) for t in TABLES.values()]


def materialize(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Create or replace ``table`` with the rows of ``df``.

    With ``partition_by``, the rows of a partition are brought together before
    the write, so that each has few files; adaptive execution splits large ones.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.format("parquet").options(**CODEC).mode("overwrite").partitionBy(*partition_by).saveAsTable(table)


def append(df: DataFrame, table: str) -> None:
    """Add rows to a table, matched by column name."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.mode("append").insertInto(table)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql("SELECT * FROM IDENTIFIER(:t)", args={"t": name})


def document(spark: SparkSession, table: str, comment: str, columns: Mapping[str, str]) -> None:
    spark.sql(f"COMMENT ON TABLE IDENTIFIER(:t) IS {_quoted(comment)}", args={"t": table})
    for column, text in columns.items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {column} COMMENT {_quoted(text)}")


KEY_PROPERTY = "larder.primary_key"
# option of a partitioned table: an overwrite replaces only the partitions it writes
ONLY_WRITTEN = {"partitionOverwriteMode": "dynamic"}


def declare_key(spark: SparkSession, table: str, key: Iterable[str]) -> None:
    """Record the logical key as a table property. It is checked by ``check_key``, not enforced."""
    set_property(spark, table, KEY_PROPERTY, ",".join(key))


def declared_key(spark: SparkSession, table: str) -> list[str]:
    key = declared_property(spark, table, KEY_PROPERTY)
    return key.split(",") if key else []


def set_property(spark: SparkSession, table: str, name: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_quoted(name)} = {_quoted(value)})")


def declared_property(spark: SparkSession, table: str, name: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == name).take(1)
    return rows[0]["value"] if rows else None


def check_key(spark: SparkSession, table: str) -> DataFrame:
    """Rows, distinct keys and rows with a NULL in the key, for the declared key."""
    key = declared_key(spark, table)
    if not key:
        raise ValueError(f"{table} has no declared key")
    missing = F.greatest(*[F.col(c).isNull().cast("int") for c in key], F.lit(0))
    return spark.table(table).agg(
        F.count("*").alias("nb"),
        F.count_distinct(*key).alias("nb_distinct"),
        F.coalesce(F.sum(missing), F.lit(0)).cast("bigint").alias("nb_null_keys"),
    )


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database, from the catalog."""
    return spark.sql("SHOW TABLES IN IDENTIFIER(:db)", args={"db": database}).filter(
        ~F.col("isTemporary")
    ).select(F.col("namespace").alias("database"), F.col("tableName").alias("table_name")).orderBy("table_name")


def table_count(spark: SparkSession, database: str) -> DataFrame:
    return list_tables(spark, database).agg(F.count("*").alias("nb_tables"))


def environment_status(spark: SparkSession, layers: Layers = Layers()) -> DataFrame:
    """One row telling which catalog and layers are set up and how many raw tables exist."""
    # fixed values: the labels of the status line
    return table_count(spark, layers.bronze).select(
        F.lit("Environnement prêt").alias("status"),
        F.concat(F.lit("DB: "), F.current_catalog()).alias("database_info"),
        F.concat(F.lit("Schémas: "), F.lit(layers.bronze), F.lit(", "), F.lit(layers.silver)).alias(
            "schemas_info"
        ),
        "nb_tables",
    )
