"""The batch from landing files to gold tables, the catalog and the incremental load."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from larder.operators.clean import laid_out
from larder.plans import layers as batch, quality
from larder.schemas import TABLES
from larder.session import sized_for
from larder.sinks import exports, tables as sink
from larder.sinks.tables import Layers
from larder.streaming.incremental import load_new_files

DB = Layers("t_bronze", "t_silver", "t_analytics")
AS_OF = "2024-07-01"


def csv(path, name, *rows):
    table = TABLES[name]
    lines = [",".join(table.names), *rows]
    (path / table.file).write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    path = tmp_path_factory.mktemp("landing")
    csv(path, "customer_demographics", "1,Ann,2000-12-31,F,N,FR,Paris,single,25000", "1,Ann,2000-12-31,F,N,FR,Paris,single,25000")
    csv(path, "customer_service_interactions", "i1,2024-01-01,call,late,text,9.5,Resolved,No,6")
    csv(
        path, "financial_transactions",
        "t1,2024-01-06,Sale,10,Card,Shop,N,A", "t2,2024-01-07,SALE,-5,Card,Shop,N,A", "t3,2024-01-08,Refund,1,Card,Shop,N,A",
        "t4,2024-01-09,Sale,oops,Card,Shop,N,A",
    )
    csv(path, "promotions_data", "p1,Cat,Flash,0.2,2024-06-01,,N", "p2,Cat,Flash,0.2,2024-09-01,2024-08-01,N")
    csv(path, "marketing_campaigns", "c1,Name,Email,Cat,All,2024-01-01,2024-01-31,N,100,10,0.5")
    csv(path, "logistics_and_shipping", "s1,o1,2024-01-01,2024-01-05,Air,Delivered,3,N,FR,Fast")
    csv(path, "supplier_information", "u1,Sup,Cat,N,FR,Paris,-1,0.9,A")
    csv(path, "employee_records", "e1,Bob,1980-01-01,2010-01-01,IT,Dev,1000,N,FR, Bob@X.COM ")
    (path / "product_reviews.csv").write_text(
        "\t".join(TABLES["product_reviews"].names) + "\n1\tp\tr\tN\t4\t2024-01-01 00:00:00\tT\tX\tCat\n"
    )
    (path / "inventory.json").write_text(json.dumps([{"product_id": "p", "country": "FR", "warehouse": "W", "current_stock": 1}]))
    (path / "store_locations.json").write_text(json.dumps([{"store_id": "s", "postal_code": 75001}]))
    return str(path)


@pytest.fixture(scope="module")
def lake(spark, landing):
    sink.ensure_layers(spark, DB)
    sink.create_bronze(spark, DB.bronze)
    batch.load_bronze(spark, landing, DB)
    batch.build_silver(spark, DB)
    batch.build_gold(spark, DB, AS_OF)
    return spark


def test_raw_tables_are_declared(lake):
    assert sink.list_tables(lake, DB.bronze).count() == 11 == sink.table_count(lake, DB.bronze).first()[0]
    for table in TABLES.values():
        got = lake.table(f"{DB.bronze}.{table.name}")
        assert got.dtypes == [(c.name, c.type) for c in table.columns]
        assert sink.declared_key(lake, f"{DB.bronze}.{table.name}") == list(table.primary_key)


def test_volumes(lake):
    raw = dict(tuple(r) for r in batch.bronze_volumes(lake, DB).collect())
    assert raw["financial_transactions"] == 3 and raw["customer_demographics"] == 2 and raw["product_reviews"] == 1
    clean = [tuple(r) for r in batch.silver_volumes(lake, DB).collect()]
    assert [n for n, _ in clean] == sorted(n for n, _ in clean) and len(clean) == 11
    assert dict(clean)["customer_demographics_clean"] == 1


def test_gold_sales(lake):
    rows = {r["transaction_id"]: r for r in sink.read_table(lake, f"{DB.analytics}.ventes_enrichies").collect()}
    assert set(rows) == {"t1", "t2"}
    assert rows["t1"]["is_weekend"] == 1 and rows["t1"]["jour_semaine_iso"] == 6 and rows["t1"]["mois_aaaamm"] == "2024-01"
    assert rows["t2"]["amount"] is None


def test_gold_promotions(lake):
    rows = {r["promotion_id"]: r for r in lake.table(f"{DB.analytics}.promotions_actives").collect()}
    assert (rows["p1"]["is_active"], rows["p1"]["duree_jours"]) == (1, 30)
    # an end before the start was dropped; the start lies ahead
    assert (rows["p2"]["is_active"], rows["p2"]["duree_jours"]) == (0, -62)


def test_gold_customers(lake):
    row = lake.table(f"{DB.analytics}.clients_enrichis").first()
    assert (row["age"], row["age_segment"], row["income_bracket"]) == (24, "18-24", "20k-49k")


def test_documentation_and_keys(lake):
    name = f"{DB.analytics}.ventes_enrichies"
    described = {r["col_name"]: r["comment"] for r in lake.sql(f"DESCRIBE TABLE {name}").collect()}
    assert described["annee"] == "int, from transaction_date"
    assert lake.catalog.getTable(name).description.startswith("One row per sale")
    assert sink.declared_key(lake, name) == ["transaction_id"]
    assert tuple(sink.check_key(lake, name).first()) == (2, 2, 0)


def test_rebuild_replaces(lake):
    batch.build_silver(lake, DB)
    assert lake.table(f"{DB.silver}.customer_demographics_clean").count() == 1


def test_environment_status(lake):
    row = sink.environment_status(lake, DB).first()
    assert row["status"] == "Environnement prêt" and row["nb_tables"] == 11
    assert row["schemas_info"] == "Schémas: t_bronze, t_silver"


def test_failed_build_is_reported(spark):
    def boom():
        raise RuntimeError("boom")

    done = []
    with pytest.raises(RuntimeError, match="boom"):
        batch.run_together(spark, [boom, lambda: done.append(1)], at_once=1)
    assert done == [1]


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("N", None, ""), ("S", 2, "x")], "region string, n int, note string")
    target = exports.export_csv(df.coalesce(1).orderBy("region"), str(tmp_path), exports.SALES_EXPORTS["regions"], dt.date(2024, 5, 6))
    assert target.endswith("/ventes_regions_20240506")
    parts = [p for p in (tmp_path / "ventes_regions_20240506").iterdir() if p.suffix == ".csv"]
    assert "\n".join(p.read_text().strip() for p in parts) == "region,n,note\nN,,\nS,2,x"


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    table = TABLES["financial_transactions"]
    folder, state = tmp_path / "in", tmp_path / "state"
    folder.mkdir()
    spark.sql("CREATE SCHEMA IF NOT EXISTS t_stream")
    target = sink.create_table(spark, table, "t_stream")

    def land(name, *rows):
        (folder / name).write_text("\n".join([",".join(table.names), *rows]) + "\n")

    def run():
        load_new_files(spark, str(folder), table, target, str(state), rejects="t_stream.rejects").awaitTermination()
        return sorted(r["transaction_id"] for r in spark.table(target).collect())

    land("a.csv", "t1,2024-01-01,Sale,1,Card,Shop,N,A", "t2,2024-01-01,Sale,bad,Card,Shop,N,A")
    assert run() == ["t1"]
    assert run() == ["t1"]
    land("b.csv", "t3,2024-01-01,Sale,1,Card,Shop,N,A", "t4,2024-01-01,Sale,1,Card")
    assert run() == ["t1", "t3"]
    reasons = sorted(r["line_error"][0] for r in spark.table("t_stream.rejects").collect())
    assert reasons == ["amount: not a valid decimal(18,2)", "wrong number of fields"]


def test_incremental_load_of_json(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    spark.sql("CREATE SCHEMA IF NOT EXISTS t_stream")
    target = sink.create_table(spark, TABLES["store_locations"], "t_stream")
    for i in range(2):
        (folder / f"{i}.json").write_text(json.dumps([{"store_id": f"s{i}", "postal_code": 75000 + i}]))
        load_new_files(spark, str(folder), "store_locations", target, str(tmp_path / "state")).awaitTermination()
    assert sorted((r["store_id"], r["postal_code"]) for r in spark.table(target).collect()) == [("s0", "75000"), ("s1", "75001")]


def test_stored_transactions_are_sorted_without_a_shuffle(spark):
    df = spark.range(100).selectExpr(
        "CAST(id AS STRING) AS transaction_type", "CAST(id AS STRING) AS region", "current_date() AS transaction_date"
    )
    plan = laid_out(df, "financial_transactions")._jdf.queryExecution().executedPlan().toString()
    assert "Sort [transaction_type" in plan and "Exchange" not in plan


def test_sized_for():
    big = sized_for(100 * 1024**4, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 4096 + 1)
    assert sized_for(100 * 1024**4, 8000, most=50_000)["spark.sql.shuffle.partitions"] == "50000"
    assert sized_for(10 * 1024**2, 8)["spark.sql.shuffle.partitions"] == "24"


def test_profiles(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), (None, 2)], "k string, v int")
    missing = {tuple(r) for r in quality.missing_values_profile({"t": df}).collect()}
    assert missing == {("t", "k", 1, 3), ("t", "v", 1, 3)}
    spread = [tuple(r) for r in quality.dimension_distribution(df, ["k"]).select("value", "nb_rows").collect()]
    assert spread == [("a", 2), (None, 1)]
    assert tuple(quality.uniqueness_check(df, "k").first()) == (3, 1)
    assert quality.age_bounds_check(spark.createDataFrame([(None,), (121,), (-1,), (30,)], "age int")).first()[0] == 2
    overview = quality.table_overview({"t": (df.withColumn("d", F.lit("2024-01-01").cast("date")), "d", ["k"])}).first()
    assert (overview["nb_rows"], overview["nb_keys"], str(overview["first_day"])) == (3, 1, "2024-01-01")
