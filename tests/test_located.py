"""Rejected rows with their place, and JSON arrays judged element by element."""

import json

import pytest

from larder.schemas import TABLES
from larder.sources import files

TX = TABLES["financial_transactions"]


@pytest.mark.parametrize("split", ["128m", "700b"])
def test_every_reject_has_its_record(spark, tmp_path, split):
    """Also where a file is read in several splits by several tasks."""
    bad, want = {3, 4, 50, 199}, set()
    for name in ("a", "b"):
        lines = [",".join(TX.names)]
        for k in range(1, 201):
            lines.append(f"{name}{k},2024-01-01,Sale,{'x' if k in bad else k},Card,Shop,N,A" + (",more" if k == 7 else ""))
            if k in bad or k == 7:
                want.add((f"{name}.csv", k, lines[-1]))
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = files.validate_located(spark, str(tmp_path), TX).collect()
        opened = files.validate_load(spark, str(tmp_path), TX).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {(r.file.rsplit("/", 1)[1], r.record, r.raw) for r in rows} == want and len(rows) == len(want)
    assert (opened > 4) == (split == "700b") and len({r.block_start for r in rows}) == (1 if split == "128m" else len({r.block_start for r in rows}))
    assert any(r.block_start for r in rows) == (split == "700b")
    assert all(r.record_in_block <= r.record for r in rows)


def test_places_of_tsv_and_json_lines(spark, tmp_path):
    reviews = TABLES["product_reviews"]
    rows = ["1\tp\tr\tN\t4\t2024-01-01\tT\tX\tC", "2\tp\tr\tN\t4\tyesterday\tT\tX\tC"]
    (tmp_path / "r.csv").write_text("\n".join(["\t".join(reviews.names), *rows]) + "\n")
    (found,) = files.validate_located(spark, f"{tmp_path}/r.csv", reviews).collect()
    assert (found.record, found.line_error) == (2, ["review_date: not a valid date"])
    (tmp_path / "s.json").write_text('{"store_id": "a"}\n{"store_id": \n{"store_id": "b", "employee_count": "many"}\n')
    found = files.validate_located(spark, f"{tmp_path}/s.json", "store_locations").collect()
    assert sorted(r.record for r in found) == [2, 3]


def elements(spark, path):
    loaded = files.load_json_elements(spark, str(path), "store_locations")
    good = sorted(r.store_id for r in loaded.good.collect())
    rejects = sorted((r.line_error[0].replace(f"file://{path}", "").replace(f"file:{path}", ""), r.raw) for r in loaded.rejects.collect())
    return good, rejects


def test_one_broken_element_costs_itself_alone(spark, tmp_path):
    text = """[
  {"store_id": "a, {b} ]", "postal_code": 75001},
  {"store_id": "c" "postal_code": 1},
  {"store_id": "d", "employee_count": "many"},
  {"store_id": "open, "employee_count": 3},
  {"store_id": "e", "employee_count": 4},
  {"store_id": "unclosed", "employee_count":
  {"store_id": "f \\\\"quoted\\\\" \\\\\\\\", "city": "x"}, 17,
  {"store_id": "g"}
]""".replace("\\\\", "\\")
    (tmp_path / "s.json").write_text(text)
    good, rejects = elements(spark, tmp_path / "s.json")
    assert good == ["a, {b} ]", "e", 'f "quoted" \\', "g"]
    reasons = [r[0].split(": ", 1) for r in rejects]
    assert [r[0] for r in reasons].count("not valid JSON") == 4 and ["employee_count", "not a valid bigint"] in reasons
    assert {raw for reason, raw in rejects if "JSON" in reason} >= {"17", '{"store_id": "c" "postal_code": 1}'}
    assert any(reason.endswith("element 2") for reason, _ in rejects)


def test_whole_files_and_others_side_by_side(spark, tmp_path):
    for k in range(3):
        rows = [{"store_id": f"{k}-{i}", "postal_code": 10 * i} for i in range(50)]
        text = json.dumps(rows, indent=1)
        (tmp_path / f"{k}.json").write_text(text[:-30] if k == 1 else text)
    good, rejects = elements(spark, tmp_path)
    assert len(good) == 149 and len(rejects) == 1 and "element 50" in rejects[0][0]


@pytest.mark.parametrize("text, good, bad", [("[]", 0, 0), ("", 0, 0), ("[", 0, 0), ("junk", 0, 1), ('junk [{"store_id": "a"}]', 1, 1), ('[{"store_id": "a"}', 1, 0)])
def test_odd_files(spark, tmp_path, text, good, bad):
    (tmp_path / "s.json").write_text(text)
    rows, rejects = elements(spark, tmp_path / "s.json")
    assert (len(rows), len(rejects)) == (good, bad)
