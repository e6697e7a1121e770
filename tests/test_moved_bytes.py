"""What the batch moves and stores: joins without needless shuffles, compressed files, elements parsed once."""

import glob

import pytest
from pyspark.sql import Row

from larder.sinks import tables as sink
from larder.sources import files, landing
from larder.sources.star_schema import SOURCE_SCHEMAS, StarSchema


class Given(StarSchema):
    """Small source tables from rows, stored as files, so that Spark knows their size."""

    def __init__(self, spark, folder):
        super().__init__(spark, str(folder))
        key = range(1, 41)
        rows = {
            "region": [Row(r_regionkey=0, r_name="ASIA")],
            "nation": [Row(n_nationkey=0, n_name="INDIA", n_regionkey=0)],
            "customer": [(k, f"c{k}", 0, 5.5, "AUTO") for k in key],
            "supplier": [(k, f"s{k}", 0, 1.25) for k in key],
            "part": [(k, f"p{k}", "B", "T", 3, 2.0) for k in key],
            "orders": [(k, k, "F", 10.0, None, "LOW") for k in key],
            "lineitem": [(k, k, k, 1, 3.0, 100.0, 0.1, 0.05, "A", "F", None) for k in key],
        }
        for name, found in rows.items():
            frame = spark.createDataFrame([tuple(r) for r in found], SOURCE_SCHEMAS[name])
            frame.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    return Given(spark, tmp_path_factory.mktemp("given"))


@pytest.mark.parametrize("table", ["logistics_and_shipping", "inventory", "financial_transactions", "product_reviews"])
def test_facts_are_not_shuffled_for_small_tables(given, table):
    rows = given.bronze(table)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and rows.count() == 40


def test_landing_files_are_compressed_and_load_whole(spark, given):
    folder = landing.stores_json(given)
    assert all(f.endswith(".gz") for f in glob.glob(f"{folder}/part-*"))
    loaded = files.load_json(spark, folder, "store_locations")
    # employee_count is supplier % 50 - 1: 6, 16, 26 and 36 leave 7, 17, 27, 37 broken
    assert loaded.good.count() == 36 and loaded.rejects.count() == 4
    folder = landing.table_csv(given, "supplier_information")
    assert all(f.endswith(".gz") for f in glob.glob(f"{folder}/part-*"))
    assert files.read_text_fields(spark, folder, "supplier_information").count() == 40


def test_stored_tables_are_compressed(spark, given, tmp_path):
    spark.sql(f"CREATE SCHEMA moved LOCATION '{tmp_path}/moved'")
    sink.create_table(spark, landing.TABLES["inventory"], "moved")
    sink.append(given.bronze("inventory"), "moved.inventory")
    sink.materialize(given.bronze("inventory"), "moved.copy")
    stored = glob.glob(f"{tmp_path}/moved/*/part-*.parquet")
    assert len(stored) > 1 and all("zstd" in f for f in stored)
    spark.sql("DROP SCHEMA moved CASCADE")


def test_elements_are_parsed_once_in_one_scan(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"store_id":"a"},\n{"store_id":"b"\n{"store_id":"c"} junk,\n3]')
    (tmp_path / "b.json").write_text('[\n{"store_id":"d"},\n{"employee_count":"1"}\n]')
    loaded = files.load_json_elements(spark, str(tmp_path), "store_locations")
    for side in (loaded.good, loaded.rejects):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1 and plan.count("Relation [") == 1
    assert sorted(r[0] or "" for r in loaded.good.select("store_id").collect()) == ["", "a", "c", "d"]
    reasons = sorted(e.split("/")[-1] for r in loaded.rejects.collect() for e in r["line_error"])
    assert reasons == ["a.json element 2", "a.json element 4"]


def test_long_text_in_an_element(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"store_id":"a","address":"' + "x" * 100_000 + '"},\n{"store_id":\n]')
    loaded = files.load_json_elements(spark, str(tmp_path), "store_locations")
    assert [e for r in loaded.rejects.collect() for e in r["line_error"] if "longer" in e] == ["address: longer than 500"]
