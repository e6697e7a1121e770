"""Interval joins against a brute-force join in Python."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from larder.operators.intervals import count_active, totals_within
from row_join import left_interval_join

EPOCH = dt.date(2024, 1, 1)
KEYS = ["N", "S", None]

day = st.one_of(st.none(), st.integers(0, 70))
fact = st.tuples(st.sampled_from(KEYS), day, st.one_of(st.none(), st.integers(-5, 50)))
interval = st.tuples(st.sampled_from(KEYS), day, day)


def date(n):
    return None if n is None else EPOCH + dt.timedelta(n)


def frames(spark, facts, intervals):
    f = spark.createDataFrame([(i, k, date(d), v) for i, (k, d, v) in enumerate(facts)], "id int, k string, d date, v int")
    p = spark.createDataFrame(
        [(f"p{i}", k, date(s), date(e)) for i, (k, s, e) in enumerate(intervals)],
        "pid string, k string, s date, e date",
    )
    return f, p


def covers(f, p):
    return None not in (f[0], f[1], p[0], p[1], p[2]) and f[0] == p[0] and p[1] <= f[1] <= p[2]


def check(spark, facts, intervals):
    f, p = frames(spark, facts, intervals)

    got = {
        (r["k"], r["day"]): (r["n"], r["v"], r["active"])
        for r in count_active(
            f, p, "k", "d", "s", "e", {"n": F.lit(1), "v": F.col("v")}, {"active": F.lit(1)}
        ).collect()
    }
    want = {}
    for x in facts:
        k = (x[0], date(x[1]))
        n, v, _ = want.get(k, (0, None, 0))
        v = v if x[2] is None else (v or 0) + x[2]
        want[k] = (n + 1, v, sum(covers(x, y) for y in intervals))
    assert got == want

    totals = totals_within(
        f, p, "k", "d", "s", "e", {"n": F.lit(1), "v": F.col("v")}, ["pid", "s", "e"]
    )
    got = {r["pid"]: (r["n"], r["v"]) for r in totals.collect()}
    want = {
        f"p{i}": (
            sum(covers(x, y) for x in facts),
            sum(x[2] or 0 for x in facts if covers(x, y)),
        )
        for i, y in enumerate(intervals)
    }
    assert got == want

    got = sorted((r["id"], str(r["pid"])) for r in left_interval_join(f, p, "k", "d", "s", "e").collect())
    want = []
    for i, x in enumerate(facts):
        hits = [f"p{j}" for j, y in enumerate(intervals) if covers(x, y)]
        want += [(i, h) for h in hits or ["None"]]
    assert got == sorted(want)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(fact, max_size=25), st.lists(interval, max_size=8))
def test_random(spark, facts, intervals):
    check(spark, facts, intervals)


def test_edges(spark):
    facts = [("N", 0, 1), ("N", 31, 2), ("N", 32, None), ("S", 5, 4), (None, 5, 5), ("N", None, 6)]
    intervals = [
        ("N", 0, 0), ("N", 0, 31), ("N", 31, 60), ("N", 60, 0), ("N", None, 31), ("N", 0, None), (None, 0, 60), ("S", 6, 9),
    ]
    check(spark, facts, intervals)


def test_group_adds_up_several_intervals(spark):
    f, p = frames(spark, [("N", 1, 10), ("N", 5, 20), ("N", 9, 40)], [("N", 0, 2), ("N", 4, 9)])
    p = p.withColumn("pid", F.lit("same"))
    got = totals_within(f, p, "k", "d", "s", "e", {"v": F.col("v")}, ["pid"]).collect()
    assert [tuple(r) for r in got] == [("same", 70)]


def test_far_end_makes_no_far_months(spark):
    f, p = frames(spark, [("N", 1, 10)], [("N", 0, 5)])
    p = p.withColumn("e", F.lit("9999-12-31").cast("date")).withColumn("s", F.lit("0001-01-01").cast("date"))
    assert left_interval_join(f, p, "k", "d", "s", "e").count() == 1
    assert totals_within(f, p, "k", "d", "s", "e", {"v": F.col("v")}, ["pid"]).first()["v"] == 10
    assert count_active(f, p, "k", "d", "s", "e", {"v": F.col("v")}, {"a": F.lit(1)}).first()["a"] == 1


def test_hot_region(spark):
    """One region and one day hold most rows; every sum must still be whole."""
    rng = random.Random(7)
    facts = [("N", 10 if rng.random() < 0.6 else rng.randrange(60), 1) for _ in range(3000)]
    intervals = [("N", rng.randrange(20), 20 + rng.randrange(40)) for _ in range(60)]
    check(spark, facts, intervals)


@pytest.mark.parametrize("operator", ["count_active", "totals_within"])
def test_facts_are_reduced_before_any_join_or_window(spark, operator):
    f, p = frames(spark, [("N", 1, 10)], [("N", 0, 5)])
    if operator == "count_active":
        df = count_active(f, p, "k", "d", "s", "e", {"v": F.col("v")}, {"a": F.lit(1)})
    else:
        df = totals_within(f, p, "k", "d", "s", "e", {"v": F.col("v")}, ["pid"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # top-down print: the window sits above a partial aggregate over the facts
    assert plan.index("Window") < plan.index("partial_sum(v")
