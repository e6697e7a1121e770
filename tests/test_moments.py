"""Figures that must not depend on order or partitioning; sweeps; sketches."""

import random

import pytest
from pyspark.sql import functions as F

from larder.functions import numeric as num
from larder.operators.intervals import levels
from larder.plans import promotions, quality, reviews, service


def test_correlations_are_the_same_in_every_partitioning(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(1, 10**9), rng.choice([None, *range(1, 6)]), f"p{rng.randrange(60)}") for _ in range(4000)]
    df = spark.createDataFrame(rows, "cents bigint, rating int, product_id string")
    calls = df.select((F.col("cents") / 100).cast("decimal(18,2)").alias("duration_minutes"), F.col("rating").alias("customer_satisfaction"))
    stars = df.select("product_id", F.lit("c").alias("product_category"), "rating")
    for report, rows in ((service.duration_satisfaction_correlation, calls), (reviews.review_volume_vs_rating, stars)):
        one, two = (report(r).collect() for r in (rows.repartition(1), rows.orderBy(F.rand(3)).repartition(13)))
        assert one == two and one[0]["correlation"] is not None
    exact = [df.repartition(n).agg(num.correlation(F.col("cents"), F.col("rating"))).first()[0] for n in (1, 7, 40)]
    assert exact[0] == exact[1] == exact[2] == pytest.approx(df.agg(F.corr("cents", F.col("rating").cast("double"))).first()[0], abs=1e-12)


def test_correlation_of_little(spark):
    for rows in ([], [(1, 2)], [(1, 5), (2, 5)], [(None, 1), (1, None)]):
        df = spark.createDataFrame(rows, "x bigint, y bigint")
        assert df.agg(num.correlation(F.col("x"), F.col("y"))).first()[0] is None
    big = spark.createDataFrame([(10**17, 1), (-(10**17), 2), (3, 3)], "x bigint, y bigint")
    assert big.agg(num.correlation(F.col("x"), F.col("y"))).first()[0] == pytest.approx(-0.5)


def test_levels_against_every_day(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), *rng.choices(range(1, 40), k=2), rng.randrange(5)) for _ in range(60)] + [("a", None, 3, 1), ("a", 3, None, 1)]
    df = spark.createDataFrame(rows, "k string, s int, e int, v int")
    day = lambda c: F.date_add(F.lit("2024-01-01").cast("date"), F.col(c))
    got = levels(df.select("k", "v", day("s").alias("s"), day("e").alias("e")), ["k"], "s", "e", {"n": F.lit(1), "v": F.col("v")})
    seen = {}
    for r in got.collect():
        for d in range((r.last_day - r.first_day).days + 1):
            at = (r.k, (r.first_day.toordinal() + d))
            assert at not in seen
            seen[at] = (r.n, r.v)
    want = {}
    for k, s, e, v in rows:
        for d in range(s, e + 1) if s and e else []:
            n, total = want.get((k, d + 738886), (0, 0))
            want[k, d + 738886] = (n + 1, total + v)
    assert seen == want


def test_elasticity_reads_facts_once_and_makes_no_row_a_day(spark, stored):
    df = promotions.discount_elasticity_by_category(stored("financial_transactions"), stored("promotions_data"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("financial_transactions_clean") == 1


def test_key_sketches_are_near_the_exact_count(spark):
    df = spark.range(300_000).selectExpr("id % 40000 AS k", "CAST(id % 3 AS STRING) AS w", "id % 10 AS part").unionByName(
        spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 'x' AS w, 0L AS part")
    )
    sketches = quality.key_sketches(df, ["k", "w"], ["part"])
    exact = df.dropna().select("k", "w").distinct().count()
    merged = quality.sketched_keys(sketches).first()[0]
    assert abs(merged - exact) / exact < 0.02
    by_part = {r.part: r.nb_keys_estimated for r in quality.sketched_keys(sketches, ["part"]).collect()}
    true = {r.part: r.n for r in df.dropna().groupBy("part").agg(F.count_distinct("k", "w").alias("n")).collect()}
    assert all(abs(by_part[p] - n) / n < 0.02 for p, n in true.items())
    assert quality.sketched_keys(quality.key_sketches(df.limit(0), ["k"])).first()[0] in (0, None)
