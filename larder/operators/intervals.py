"""Joining facts to date intervals inside a region.

The relation is ``fact.key = interval.key AND fact.date BETWEEN start AND end``.
With a handful of regions an equi-join on the key alone gives a handful of huge
partitions, and a fact inside n intervals appears n times. Aggregates over that
join do not need its rows, so neither operator builds them:

* ``count_active`` puts the number of covering intervals on each (key, day);
* ``totals_within`` gives each interval the totals of the facts it covers.

Both reduce the facts to (key, day) first, map side, and then run one window per
key over at most one row per calendar day. Their cost does not depend on how
long the intervals are or how many of them overlap.

An interval with a NULL start, end or key covers nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _running(*partition: str):
    return (
        Window.partitionBy(*partition)
        .orderBy(F.col("day").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _usable(intervals: DataFrame, key: str, start: str, end: str) -> DataFrame:
    return intervals.filter(
        F.col(key).isNotNull() & (F.col(start) <= F.col(end))
    )


def count_active(
    facts: DataFrame,
    intervals: DataFrame,
    key: str,
    date: str,
    start: str,
    end: str,
    measures: dict[str, Column],
    counts: dict[str, Column],
) -> DataFrame:
    """Facts per (key, day) with the number of intervals covering that day.

    ``measures`` maps output names to additive row expressions of the facts
    (counts as ``F.lit(1)``, sums as the column); each is summed per day.
    ``counts`` maps output names to whole-number expressions of the intervals,
    summed over those covering the day: ``F.lit(1)`` counts them. Facts with a
    NULL key or day keep rows of their own, covered by nothing.
    """
    names, totals = list(measures), list(counts)
    fact_points = facts.select(
        F.col(key),
        F.col(date).alias("day"),
        *[c.alias(n) for n, c in measures.items()],
        *[F.lit(0).cast("bigint").alias(n) for n in totals],
        F.lit(True).alias("_fact"),
    )
    nothing = [F.lit(None).cast(fact_points.schema[n].dataType).alias(n) for n in names]
    edges = F.array(
        F.struct(F.col(start).alias("day"), F.lit(1).alias("sign")),
        F.struct(F.date_add(F.col(end), 1).alias("day"), F.lit(-1).alias("sign")),
    )
    interval_points = (
        _usable(intervals, key, start, end)
        .select(F.col(key), F.explode(edges).alias("_edge"), *[c.alias(n) for n, c in counts.items()])
        .select(
            key,
            F.col("_edge.day").alias("day"),
            *nothing,
            *[(F.col(n) * F.col("_edge.sign")).cast("bigint").alias(n) for n in totals],
            F.lit(False).alias("_fact"),
        )
    )
    daily = (
        fact_points.unionByName(interval_points)
        .groupBy(key, "day")
        .agg(*[F.sum(n).alias(n) for n in names + totals], F.max("_fact").alias("_fact"))
    )
    return daily.select(
        key, "day", *names, *[F.sum(n).over(_running(key)).alias(n) for n in totals], "_fact"
    ).filter("_fact").drop("_fact")


def levels(intervals: DataFrame, keys: list[str], start: str, end: str, counts: dict[str, Column]) -> DataFrame:
    """Stretches of days over which the same intervals of ``keys`` run: keys, first_day, last_day and ``counts``.

    ``counts`` maps output names to whole-number expressions of the intervals,
    summed over those that run; ``F.lit(1)`` counts them. A sweep over starts and
    ends gives at most two stretches an interval, however long it is. Stretches
    without any interval are left out, as are intervals with a NULL start or end
    or a start after the end.
    """
    names = list(counts)
    edges = (
        intervals.filter(F.col(start) <= F.col(end))
        .select(
            *keys, F.lit(1).alias("_running"), *[c.alias(n) for n, c in counts.items()],
            F.col(start).alias("_on"), F.date_add(F.col(end), 1).alias("_off"),
        )
        .unpivot([*keys, "_running", *names], ["_on", "_off"], "_side", "first_day")
    )
    signed = {n: F.sum(F.when(F.col("_side") == "_on", F.col(n)).otherwise(-F.col(n))).alias(n) for n in ["_running", *names]}
    changes = edges.groupBy(*keys, "first_day").agg(*signed.values())
    sweep = Window.partitionBy(*keys).orderBy("first_day")
    so_far = sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        changes.select(
            *keys, "first_day", F.date_sub(F.lead("first_day").over(sweep), 1).alias("last_day"),
            *[F.sum(n).over(so_far).alias(n) for n in ["_running", *names]],
        )
        .filter("_running > 0")
        .drop("_running")
    )


def totals_within(
    facts: DataFrame,
    intervals: DataFrame,
    key: str,
    date: str,
    start: str,
    end: str,
    measures: dict[str, Column],
    group: list[str],
) -> DataFrame:
    """Per ``group`` of interval columns: sums of the facts lying inside the intervals.

    Each total is a running sum at the interval's end minus the one on the eve
    of its start. Intervals covering no fact stay, with zeros. ``measures`` are
    additive row expressions as in ``count_active``; a NULL value adds nothing.
    """
    names = list(measures)
    holds = F.col(key).isNotNull() & (F.col(start) <= F.col(end))
    # a group column may be the interval's own start or end, so the bound's day
    # and join key get names of their own
    edged = (
        intervals.select(
            *group,
            F.col(key).alias("_key"),
            F.when(holds, F.date_sub(F.col(start), 1)).alias("_eve"),
            F.when(holds, F.col(end)).alias("_last"),
        )
        .unpivot([*group, "_key"], ["_eve", "_last"], "_side", "_day")
        .select(*group, "_key", "_day", F.when(F.col("_side") == "_eve", -1).otherwise(1).alias("_sign"))
    )

    fact_points = facts.filter(F.col(key).isNotNull() & F.col(date).isNotNull()).select(
        F.col(key).alias("_key"), F.col(date).alias("day"), *[c.alias(n) for n, c in measures.items()]
    )
    empty = [F.lit(None).cast(fact_points.schema[n].dataType).alias(n) for n in names]
    edge_points = edged.filter("_day IS NOT NULL").select("_key", F.col("_day").alias("day"), *empty)
    calendar = (
        fact_points.unionByName(edge_points)
        .groupBy("_key", "day")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    upto = calendar.select(
        F.col("_key"),
        F.col("day").alias("_day"),
        *[F.coalesce(F.sum(n).over(_running("_key")), F.lit(0)).alias(n) for n in names],
    )
    signed = [
        F.coalesce(
            F.sum(F.when(F.col("_sign") < 0, -F.col(n)).otherwise(F.col(n))), F.lit(0)
        ).alias(n)
        for n in names
    ]
    return edged.join(upto, ["_key", "_day"], "left").groupBy(*group).agg(*signed)
