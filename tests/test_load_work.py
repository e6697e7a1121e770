"""What a load does for a row: every text trimmed and cast once, reasons listed for rejected rows alone."""

import pytest
from pyspark.sql import functions as F

from larder.schemas import TABLES
from larder.sources import files


@pytest.mark.parametrize("name", ["logistics_and_shipping", "product_reviews", "inventory"])
def test_a_good_row_is_cast_once_and_has_no_list_of_reasons(spark, tmp_path, name):
    table = TABLES[name]
    (tmp_path / "a").write_text("{}\n")
    loaded = files.load(spark, str(tmp_path / "a"), table)
    shown = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    plan = loaded.good._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.debug.maxToStringFields", shown)
    days = sum(c.type == "date" for c in table.columns)
    assert plan.count("gettimestamp") == days * len(files.DATE_PATTERNS) and "lambda" not in plan
    if table.format != "json":
        assert plan.count("trim(") == len(table.columns)


def test_plain_days_are_read_as_the_patterns_read_them(spark):
    texts = ["2024-02-29", "2023-02-29", "0000-01-01", "0001-01-01", "9999-12-31", "2024-2-9", "2/9/2024", "9-Feb-2024", "2024-13-01", "2024-01-1 ", " 2024-01-1", "2024-01-01T", "20240-01-1", "-024-01-01", "+024-01-01", "2024-01-01\n", "2024", "2024-01", "", "٢٠٢٤-٠١-٠١", "1582-10-10", None]  # noqa: E501
    rows = spark.createDataFrame([(t,) for t in texts], "c string")
    slow = F.coalesce(*[F.try_to_date("c", p) for p in files.DATE_PATTERNS])
    # as text: Python has no year 0
    found = rows.select("c", files.to_date(F.col("c")).cast("string").alias("day"), slow.cast("string").alias("slow")).collect()
    assert [r.day for r in found] == [r.slow for r in found]
    assert [r.day for r in found[:8]] == ["2024-02-29", None, "0000-01-01", "0001-01-01", "9999-12-31", *["2024-02-09"] * 3]


def test_reasons_and_texts_of_rejected_rows(spark, tmp_path):
    names = TABLES["supplier_information"].names
    lines = [
        ",".join(names), "s1,A,C,N,FR,Paris,3,0.5,A", "s2,A,C,N,FR,Paris,x,9999,ABCDEF", ' ,A,C,N,FR," NULL ",4.5,,A', "s4,A",
        "s5,A,C,N,FR,Paris,,NULL, ", '"s6 "," A",C,N,FR,Paris,4.5,0.12345,A',
    ]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    loaded = files.load_csv(spark, str(tmp_path / "a.csv"), "supplier_information")
    good = {tuple(r) for r in loaded.good.selectExpr("supplier_id", "supplier_name", "city", "lead_time", "CAST(reliability_score AS STRING)", "quality_rating").collect()}
    assert good == {("s1", "A", "Paris", 3, "0.5000", "A"), ("s5", "A", "Paris", None, None, None), ("s6", "A", "Paris", 5, "0.1235", "A")}
    rejects = {r.raw: r.line_error for r in loaded.rejects.collect()}
    assert rejects == {
        "s2,A,C,N,FR,Paris,x,9999,ABCDEF": ["lead_time: not a valid bigint", "reliability_score: not a valid decimal(6,4)", "quality_rating: longer than 5"],
        ",A,C,N,FR,,4.5,,A": ["supplier_id: missing key"],
        "s4,A": ["wrong number of fields"],
    }
