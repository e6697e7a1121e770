"""Loaders on files with planted faults."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from larder.schemas import TABLES
from larder.sources import files

HEADER = "transaction_id,transaction_date,transaction_type,amount,payment_method,entity,region,account_code"


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "financial_transactions.csv"
    path.write_text(
        "\n".join(
            [
                HEADER,
                't1, 2024-01-05 ,Sale,10.50,Card,"Shop, Main",N,A1',
                "t2,2024-01-06,Sale,bad,Card,Shop,N,A1",
                "t3,2024-13-01,Sale,1,Card,Shop,N,A1",
                't4,NULL,"",,   ,"  ",NULL,A1',
                "t5,2024-01-06,Sale,1,Card,Shop,N",
                "t6,2024-01-06,Sale,1,Card,Shop,N,A1,extra",
                "NULL,2024-01-06,Sale,1,Card,Shop,N,A1",
                f"t8,2024-01-06,{'x' * 51},1,Card,Shop,N,A1",
                't9,01/31/2024,"a ""quoted"" word",1.005,Card,"two\nlines",N,A1',
                "t10,05-Feb-2024,Sale,99999999999999999.99,Card,Shop,N,A1",
            ]
        )
        + "\n"
    )
    return str(path)


def by_id(df):
    return {r["transaction_id"]: r.asDict() for r in df.collect()}


def test_csv_good_rows(spark, csv):
    loaded = files.load_csv(spark, csv, "financial_transactions", multiLine=True)
    assert [f.dataType for f in loaded.good.schema] == [f.dataType for f in TABLES["financial_transactions"].schema]
    good = by_id(loaded.good)
    assert set(good) == {"t1", "t4", "t9"}
    assert good["t1"]["transaction_date"] == dt.date(2024, 1, 5)
    assert good["t1"]["entity"] == "Shop, Main" and good["t1"]["amount"] == Decimal("10.50")
    assert [k for k, v in good["t4"].items() if v is not None] == ["transaction_id", "account_code"]
    assert good["t9"]["transaction_date"] == dt.date(2024, 1, 31)
    assert good["t9"]["transaction_type"] == 'a "quoted" word' and good["t9"]["entity"] == "two\nlines"
    assert good["t9"]["amount"] == Decimal("1.01")


def test_csv_rejects(spark, csv):
    rejects = files.validate_load(spark, csv, "financial_transactions", multiLine=True).collect()
    reasons = {r["raw"].split(",")[0]: r["line_error"] for r in rejects}
    assert reasons["t2"] == ["amount: not a valid decimal(18,2)"]
    assert reasons["t3"] == ["transaction_date: not a valid date"]
    assert reasons["t5"] == reasons["t6"] == ["wrong number of fields"]
    assert reasons[""] == ["transaction_id: missing key"]
    assert reasons["t8"] == ["transaction_type: longer than 50"]
    assert reasons["t10"] == ["amount: not a valid decimal(18,2)"]
    assert len(rejects) == 7


def test_count_and_pruned_columns_agree_with_collect(spark, csv):
    loaded = files.load_csv(spark, csv, "financial_transactions", multiLine=True)
    assert loaded.good.count() == len(loaded.good.collect()) == 3
    assert loaded.good.select("region").count() == 3
    assert len(loaded.good.select("account_code").collect()) == 3
    assert loaded.rejects.count() == 7


def test_reconcile(spark, csv):
    loaded = files.load_csv(spark, csv, "financial_transactions", multiLine=True)
    got = files.reconcile_load(spark, csv, "financial_transactions", loaded.good, multiLine=True).first()
    assert tuple(got) == (10, 3, 7)


def test_splittable_option(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(f"{HEADER}\nt1,2024-01-05,Sale,1,Card,Shop,N,A1\nt2,2024-01-05,Sale,x,Card,Shop,N,A1\n")
    loaded = files.load_csv(spark, str(path), "financial_transactions", multiLine=False)
    assert set(by_id(loaded.good)) == {"t1"} and loaded.rejects.count() == 1


def test_several_files_each_with_a_header(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(f"{HEADER}\nt{i},2024-01-05,Sale,1,Card,Shop,N,A1\n")
    assert set(by_id(files.load_csv(spark, str(tmp_path), "financial_transactions").good)) == {"t0", "t1", "t2"}


@pytest.fixture
def tsv(tmp_path):
    path = tmp_path / "product_reviews.csv"
    lines = [
        TABLES["product_reviews"].names,
        ["1", "p", "r", "Name", "4.5", "2024-02-03 10:11:12", "Title", 'say "hi", ok', "Cat"],
        ["2", "p", "r", "Name", "abc", "2024-02-03 10:11:12", "Title", "Text", "Cat"],
        ["zz", "p", "r", "Name", "4", "2024-02-03 10:11:12", "Title", "Text", "Cat"],
        ["4", "p", "r", "Name", "4", "not a date", "Title", "Text", "Cat"],
        ["5", "p", "r", "Name", "4", "2024-02-03", "Title", "Text"],
        ["6", "p", "r", "Name", "4", "2024-02-03", "Title", "Text", "Cat", "surplus"],
        ["8", "p", "r", "Name", "123", "2024-02-03", "Title", "Text", "Cat"],
        ["7", "p", "r", " NULL ", "4", "", "  ", "Text", "Cat"],
    ]
    path.write_text("\n".join("\t".join(fields) for fields in lines) + "\n")
    return str(path)


def test_reviews_tsv(spark, tsv):
    loaded = files.load_reviews_tsv(spark, tsv)
    good = {r["review_id"]: r.asDict() for r in loaded.good.collect()}
    assert set(good) == {1, 2, 5, 6, 7}
    assert good[1]["rating"] == 5 and good[1]["review_text"] == 'say "hi", ok'
    assert good[1]["review_date"] == dt.date(2024, 2, 3)
    assert good[2]["rating"] is None
    assert good[5]["product_category"] is None and good[6]["product_category"] == "Cat"
    assert good[7]["reviewer_name"] is None and good[7]["review_title"] is None and good[7]["review_date"] is None
    reasons = sorted(tuple(r["line_error"]) for r in loaded.rejects.collect())
    assert reasons == [
        ("rating: not a valid int",), ("review_date: not a valid date",), ("review_id: missing key",),
    ]
    assert loaded.good.count() == 5


def test_reviews_read_with_the_wrong_separator_load_nothing(spark, tsv):
    loaded = files.load_csv(spark, tsv, "product_reviews")
    assert loaded.good.count() == 0 and loaded.rejects.count() == 8


def write_json(path, rows):
    path.write_text(json.dumps(rows))
    return str(path)


def test_inventory_json(spark, tmp_path):
    base = {
        "product_id": "p", "product_category": " c ", "region": "", "country": "   ", "warehouse": "w",
        "current_stock": 7, "reorder_point": "5", "lead_time": 3.6, "last_restock_date": "2024-01-02",
    }
    path = write_json(
        tmp_path / "inventory.json",
        [base, {**base, "current_stock": "bad"}, {**base, "last_restock_date": "2024-02-31"}, {"product_id": "q"}],
    )
    loaded = files.load_json(spark, path, "inventory")
    first, second = sorted(loaded.good.collect(), key=lambda r: r["product_id"])
    # no trimming and no NULL texts in this format
    assert (first["product_category"], first["region"], first["country"]) == (" c ", "", "   ")
    assert (first["current_stock"], first["reorder_point"], first["lead_time"]) == (7, 5, 4)
    assert first["last_restock_date"] == dt.date(2024, 1, 2)
    assert second["product_id"] == "q" and second["current_stock"] is None
    reasons = sorted(r["line_error"][0] for r in loaded.rejects.collect())
    assert reasons == ["current_stock: not a valid bigint", "last_restock_date: not a valid date"]


def test_store_locations_json(spark, tmp_path):
    path = write_json(
        tmp_path / "store_locations.json",
        [
            {"store_id": "s1", "postal_code": 75001, "square_footage": 1250.126, "employee_count": 4},
            {"store_id": "s2", "postal_code": "AB1 2CD", "square_footage": "9", "employee_count": None},
        ],
    )
    good = {r["store_id"]: r for r in files.load(spark, path, "store_locations").good.collect()}
    assert good["s1"]["postal_code"] == "75001" and good["s2"]["postal_code"] == "AB1 2CD"
    assert good["s1"]["square_footage"] == Decimal("1250.13")


def test_preview_and_listing(spark, tsv, tmp_path):
    seen = files.preview_file(spark, tsv, "product_reviews").collect()
    assert len(seen) == 5 and seen[0]["review_id"] == "1"
    listed = files.list_stage(spark, str(tmp_path)).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in listed] == ["product_reviews.csv"] and listed[0]["length"] > 0


def test_broken_json_lines_are_rejects(spark, tmp_path):
    path = tmp_path / "inventory.json"
    path.write_text('{"product_id": "P1"}\n{"product_id": "P2"\ntext\n\n{"product_id": "P3"}\n')
    loaded = files.load_json(spark, str(path), "inventory")
    assert sorted(r["product_id"] for r in loaded.good.collect()) == ["P1", "P3"] and loaded.good.count() == 2
    rejects = loaded.rejects.collect()
    assert sorted(r["raw"] for r in rejects) == ["text", '{"product_id": "P2"']
    assert all(r["line_error"][0].startswith("not valid JSON: file:") for r in rejects)
    assert tuple(files.reconcile_load(spark, str(path), "inventory", loaded.good).first()) == (4, 2, 2)


def test_an_array_with_a_broken_element_is_one_visible_reject(spark, tmp_path):
    path = tmp_path / "inventory.json"
    path.write_text('[{"product_id": "P1"},\n {"product_id": P2},\n {"product_id": "P3"}]\n')
    loaded = files.load_json(spark, str(path), "inventory", multiLine=True)
    assert loaded.good.count() == 0 and loaded.rejects.count() == 1
    assert str(path) in loaded.rejects.first()["line_error"][0]
    path.write_text('[{"product_id": "P1"},\n {"product_id": "P3"}]\n')
    assert files.load_json(spark, str(path), "inventory", multiLine=True).good.count() == 2


def test_numbers_too_large_reject_the_row(spark, tmp_path):
    table = TABLES["customer_demographics"]
    width = len(table.names)
    path = tmp_path / "c.csv"
    rows = [[number] + [""] * (width - 1) for number in ("1", "9" * 20, "9" * 60)]
    path.write_text("\n".join([",".join(table.names), *map(",".join, rows)]) + "\n")
    loaded = files.load_csv(spark, str(path), table)
    assert [r[0] for r in loaded.good.collect()] == [1] and loaded.rejects.count() == 2


def test_large_files_split_over_tasks(spark, tmp_path):
    lines = [f"t{i},2024-01-05,Sale,1,Card,Shop,N,A1" for i in range(20_000)]
    (tmp_path / "t.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    (tmp_path / "i.json").write_text('{"product_id": "P"}\n' * 20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        plain, array = f"{tmp_path}/t.csv", f"{tmp_path}/i.json"
        assert files.load_csv(spark, plain, "financial_transactions").good.rdd.getNumPartitions() > 3
        assert files.load_json(spark, array, "inventory").good.rdd.getNumPartitions() > 3
        assert files.load_json(spark, array, "inventory", multiLine=True).good.rdd.getNumPartitions() == 1
        assert files.load_csv(spark, plain, "financial_transactions").good.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
