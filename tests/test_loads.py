"""Loads that are repeated, keyed merges, partitioned storage."""

import random

import pytest
from pyspark.sql import functions as F

from larder.operators.clean import clean
from larder.plans import layers as batch
from larder.schemas import TABLES
from larder.sinks import ledger, merges, tables as sink
from larder.sinks.tables import Layers
from larder.streaming.incremental import load_new_files

TX = TABLES["financial_transactions"]


@pytest.fixture(scope="module")
def db(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS t_loads")
    yield "t_loads"
    spark.sql("DROP SCHEMA t_loads CASCADE")


def land(path, *rows):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join([",".join(TX.names), *rows]) + "\n")
    return str(path)


def good(n, amount="1"):
    return f"t{n},2024-01-01,Sale,{amount},Card,Shop,N,A"


def held(spark, book):
    rows = sorted((r[ledger.BATCH], r.transaction_id, str(r.amount)) for r in spark.table(book.good).collect())
    return rows, sorted((r[ledger.BATCH], r.line_error[0]) for r in spark.table(book.rejects).collect())


def test_a_batch_stored_twice_is_there_once(spark, db, tmp_path):
    book = ledger.create_ledger(spark, TX, db)
    one, two = land(tmp_path / "1.csv", good(1), good(2), good(3, "bad")), land(tmp_path / "2.csv", good(2), good(4))
    assert ledger.load_batch(spark, one, book, "day 1") == (2, 1)
    first = held(spark, book)
    assert ledger.load_batch(spark, one, book, "day 1") == (2, 1)
    assert held(spark, book) == first
    assert first == ([("day 1", "t1", "1.00"), ("day 1", "t2", "1.00")], [("day 1", "amount: not a valid decimal(18,2)")])
    assert ledger.load_batch(spark, two, book, "it's day 2") == (2, 0)
    assert ledger.create_ledger(spark, TX, db) == book
    assert [tuple(r) for r in ledger.load_history(spark, book).collect()] == [("day 1", 2, 1), ("it's day 2", 2, 0)]
    assert [r.transaction_id for r in ledger.batch_rows(spark, book, "it's day 2").orderBy("transaction_id").collect()] == ["t2", "t4"]
    # a corrected file takes the place of the faulty one, its rejects go
    assert ledger.load_batch(spark, land(tmp_path / "1.csv", good(1), good(3, "5")), book, "day 1") == (2, 0)
    assert ledger.load_batch(spark, land(tmp_path / "2.csv"), book, "it's day 2") == (0, 0)
    assert held(spark, book) == ([("day 1", "t1", "1.00"), ("day 1", "t3", "5.00")], [])


def test_one_batch_opens_one_partition(spark, db):
    book = ledger.create_ledger(spark, TX, db)
    plan = ledger.batch_rows(spark, book, "day 1")._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({ledger.BATCH}" in plan


def test_stream_into_a_ledger(spark, db, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS t_loads_stream")
    book = ledger.create_ledger(spark, TX, "t_loads_stream")
    folder, state = tmp_path / "in", tmp_path / "state"

    def run():
        load_new_files(spark, str(folder), TX, book, str(state)).awaitTermination()
        rows, rejects = held(spark, book)
        return [r[1] for r in rows], [r[1] for r in rejects]

    land(folder / "a.csv", good(1), good(2, "bad"))
    wrong = "amount: not a valid decimal(18,2)"
    assert run() == run() == (["t1"], [wrong])
    # the driver dies after storing and before the commit is written: the batch runs again
    (state / "commits" / "0").unlink()
    for left in (state / "commits").glob(".0.crc"):
        left.unlink()
    assert run() == (["t1"], [wrong])
    land(folder / "b.csv", good(3))
    assert run() == (["t1", "t3"], [wrong])
    assert len(spark.table(book.good).select(ledger.BATCH).distinct().collect()) == 2
    spark.sql("DROP SCHEMA t_loads_stream CASCADE")


def raw_rows(rng, n):
    """Transactions of which many share a key, with blanks, NULL keys and negative amounts."""
    out = []
    for _ in range(n):
        key = rng.choice([None, "", " 7 "] + [str(1000 + rng.randrange(900)) for _ in range(60)])
        out.append((key, rng.choice([None, "2024-01-01", "2024-02-01"]), rng.choice(["Sale", ""]), rng.choice([None, -1, 2, 3]), "Card", "e", rng.choice(["N", "S"]), "A"))
    return out


def frame(spark, rows):
    text = spark.createDataFrame(rows, "a string, b string, c string, d int, e string, f string, g string, h string").toDF(*TX.names)
    return text.select(*[F.col(c.name).cast(c.type).alias(c.name) for c in TX.columns])


def test_merges_end_in_the_full_rebuild(spark, db):
    rng = random.Random(2)
    batches = [raw_rows(rng, n) for n in (300, 40, 150)]
    target = merges.create_mergeable(spark, TX.name, db, parts=16)
    for k in (0, 1, 1, 2, 0):  # one is repeated at once, one late
        merges.merge_clean(spark, TX.name, frame(spark, batches[k]), target)
    got = merges.clean_rows(spark, target)
    want = clean(frame(spark, sum(batches, [])), TX.name)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert tuple(sink.check_key(spark, target).first())[2] == 1
    assert merges.merge_clean(spark, TX.name, frame(spark, []), target) == []


def test_a_merge_leaves_other_partitions_alone(spark, db):
    spark.sql("CREATE SCHEMA IF NOT EXISTS t_merges")
    target = merges.create_mergeable(spark, TX.name, "t_merges", parts=16)
    rows = [(str(1_000_000 + k), "2024-01-01", "Sale", 1, "Card", "e", "N", "A") for k in range(20_000)]
    merges.merge_clean(spark, TX.name, frame(spark, rows), target)
    # neighbouring keys: 20 thousands of ids lie in at most 16 partitions, one thousand in one
    files = lambda: {r[0]: r[1] for r in spark.table(target).select("_metadata.file_path", merges.PART).distinct().collect()}
    before = files()
    late = [(str(1_003_000 + k), "2024-01-01", "Sale", 0, "Card", "e", "N", "A") for k in range(1000)]
    touched = merges.merge_clean(spark, TX.name, frame(spark, late), target)
    after = files()
    assert len(touched) == 1 and len(set(before.values())) > 5
    assert {f for f, p in before.items() if p not in touched} == {f for f, p in after.items() if p not in touched}
    assert not {f for f, p in before.items() if p in touched} & set(after)
    got = spark.table(target)
    assert got.count() == 20_000 and got.where("amount = 0").count() == 1000
    plan = got.where(F.col(merges.PART).isin(touched))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [({merges.PART}" in plan or f"PartitionFilters: [isnotnull({merges.PART}" in plan
    spark.sql("DROP SCHEMA t_merges CASCADE")


def test_gold_sales_are_stored_by_month(spark):
    layers = Layers("t_p_bronze", "t_p_silver", "t_p_analytics")
    sink.ensure_layers(spark, layers)
    rows = [(f"t{k}", f"{2020 + k % 3}-{1 + k % 12:02d}-15" if k % 50 else None, "Sale", k, "Card", "e", "N", "A") for k in range(600)]
    for name in batch.GOLD.values():
        raw = next(r for r, c in batch.CLEANINGS.items() if c.target == name[0])
        df = frame(spark, rows) if raw == TX.name else spark.createDataFrame([], TABLES[raw].schema)
        sink.materialize(df, f"{layers.silver}.{name[0]}")
    batch.build_gold(spark, layers, "2024-07-01")
    gold = spark.table(f"{layers.analytics}.ventes_enrichies")
    assert gold.count() == 600 and gold.where("annee IS NULL").count() == 12
    month = gold.where("annee = 2021 AND mois = 5")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(annee" in plan and "mois" in plan.split("PartitionFilters")[1].split("]")[0]
    opened = {f.rsplit("/", 3)[1:3][0] + "/" + f.rsplit("/", 3)[2] for f in month.inputFiles()}
    assert len(month.inputFiles()) < len(gold.inputFiles()) and all("annee=2021/mois=5" in f for f in month.inputFiles()), opened
    assert month.count() == sum(1 for r in rows if r[1] and r[1].startswith("2021-05"))
    # one file for each of 36 months and the rows without a date
    assert len(gold.inputFiles()) == len({r[1] for r in rows})
    for name in (layers.bronze, layers.silver, layers.analytics):
        spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_rollup_follows_late_duplicates(spark, db):
    """Reports over the roll-up equal those over the clean table after every merge; a sale that leaves takes its total along."""
    from larder.plans import rollups, sales

    rng = random.Random(9)
    spark.sql("CREATE SCHEMA IF NOT EXISTS t_rollup")
    target = merges.create_mergeable(spark, TX.name, "t_rollup", parts=8)
    for _ in range(3):
        touched = merges.merge_clean(spark, TX.name, frame(spark, raw_rows(rng, 120)), target)
        rollups.refresh_rollup(spark, target, "t_rollup.daily", touched)
        daily, facts = spark.table("t_rollup.daily"), merges.clean_rows(spark, target)
        for fast, slow in (
            (rollups.monthly_sales(daily), sales.monthly_sales_mom(facts).drop("growth_pct_mom")),
            (rollups.quarterly_sales(daily), sales.quarterly_sales(facts)),
            (rollups.weekday_sales(daily), sales.weekday_sales(facts)),
            (rollups.region_sales(daily), sales.region_sales_share(facts).drop("pct_total_sales").orderBy("region")),
        ):
            assert fast.columns == slow.columns and fast.collect() == slow.collect() and fast.collect()
    # all sales of a partition turn into something else: lesser rows of the same keys win
    gone = frame(spark, [(str(k), "2000-01-01", "Refund", 1, "Card", "e", "N", "A") for k in range(1000, 1900)])
    rollups.refresh_rollup(spark, target, "t_rollup.daily", merges.merge_clean(spark, TX.name, gone, target))
    daily = spark.table("t_rollup.daily")
    assert daily.agg(F.sum("nb_sales")).first()[0] == rollups.daily_rollup(merges.clean_rows(spark, target)).agg(F.sum("nb_sales")).first()[0]
    spark.sql("DROP SCHEMA t_rollup CASCADE")


def test_layer_checks_count_what_raw_rows_break(spark):
    layers = Layers("t_c_bronze", "t_c_silver", "t_c_analytics")
    sink.ensure_layers(spark, layers)
    sink.create_bronze(spark, layers.bronze)
    rows = [("t1", None, "Sale", -5, "c", "e", "N", "A")] * 3 + [(None, None, "Sale", 5, "c", "e", "N", "A"), ("t2", None, "", None, "c", "e", "N", "A")]
    sink.append(frame(spark, rows), f"{layers.bronze}.{TX.name}")
    promos = spark.sql("SELECT 'p' AS promotion_id, '' AS product_category, '' AS promotion_type, 1.5 AS discount_percentage, DATE '2024-02-01' AS start_date, DATE '2024-01-01' AS end_date, '' AS region")
    sink.append(promos, f"{layers.bronze}.promotions_data")
    batch.build_silver_checked(spark, layers)
    found = {r.table_name: tuple(r)[1:] for r in spark.table(f"{layers.analytics}.{batch.CHECKS}").collect()}
    assert found[TX.name] == (5, 3, 2, 1, 3, 0, 0) and found["promotions_data"] == (1, 1, 0, 0, 0, 1, 1)
    assert len(found) == 11 and found["inventory"] == (0, 0, 0, 0, 0, 0, 0)
    for name in (layers.bronze, layers.silver, layers.analytics):
        spark.sql(f"DROP SCHEMA {name} CASCADE")
