"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``rate = target / source_size`` times.
Documents are laid on a line, each as long as its expected copies; one random
offset per source shifts the line, and a document is emitted once for every
integer it crosses. So each source is hit exactly ``floor`` or ``ceil`` of its
expected number of documents, and each document ``floor`` or ``ceil`` of its
rate. Along the line documents are ordered by size class, so that the words
taken, and not only the documents, come near the target.

The prefix sum needs no task that sees a whole source: documents are counted in
cells (source, size class, one of ``SPREAD`` hash buckets), the few cells of a
source are summed up in order, and ranks are taken inside a cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from larder.llm.common import WORD, text_or_empty

WEIGHTS = (5, 2, 1)
CEILING = 3
SEED = "mix-1"
# hash buckets per source and size class; with some 8 classes per doubling of
# the size, a source of ten thousand million documents has cells of a few hundred thousand
SPREAD = 256

_CELL = ["mix_absent", "mix_source", "mix_class", "mix_bucket"]


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` plus its size in words; a null text has none."""
    return docs.withColumn("mix_size", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("bigint"))


def _placed(sized: DataFrame) -> DataFrame:
    # eight classes per doubling: the length of size + 1 in bits, and the three bits after the first
    bits = F.length(F.bin(F.col("mix_size") + 1))
    leading = F.when(bits < 4, F.lit(0)).otherwise(F.expr("shiftright(mix_size + 1, length(bin(mix_size + 1)) - 4) % 8"))
    return sized.select(
        "*",
        F.col("source").isNull().alias("mix_absent"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("mix_source"),
        (bits * 8 + leading).cast("int").alias("mix_class"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("mix_key"),
    ).withColumn("mix_bucket", (F.conv(F.substring("mix_key", 1, 4), 16, 10).cast("int") % SPREAD))


def source_targets(sizes: DataFrame, weights=WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """Targets from (mix_absent, mix_source, mix_source_size), one row per source.

    Sources in code point order, null last, take the weights in turn and share
    the total. A source stops at ``ceiling`` times its size and what it leaves is
    shared by the others; the sources that stop are those with the least
    ceiling per weight, so a running sum in that order finds them. The table has
    one row per source of the mixture, and its windows see that many rows.
    """
    whole = Window.orderBy("mix_absent", "mix_source")
    ratio = F.col("cap") / F.col("weight")
    before = Window.orderBy(ratio, "mix_absent", "mix_source").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = (F.row_number().over(whole) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("bigint") for w in weights]), (turn + 1).cast("int"))
    wide = "decimal(38,0)"
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("mix_source_size") * ceiling)
        .withColumn("total", F.sum("mix_source_size").over(total))
        .withColumn("weights", F.sum("weight").over(total))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weights_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "stops",
            F.col("cap").cast(wide) * (F.col("weights") - F.col("weights_before"))
            <= (F.col("total") - F.col("caps_before")).cast(wide) * F.col("weight"),
        )
        .withColumn("stopped", F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(total), F.lit(0)))
        .withColumn("stopped_weight", F.coalesce(F.sum(F.when(F.col("stops"), F.col("weight"))).over(total), F.lit(0)))
    )
    shared = (
        (F.col("total") - F.col("stopped")).cast("double")
        * F.col("weight")
        / (F.col("weights") - F.col("stopped_weight"))
    )
    return ranked.select(
        "mix_absent",
        "mix_source",
        "mix_source_size",
        F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(shared).alias("mix_target"),
    )


def mixed(docs: DataFrame, weights=WEIGHTS, ceiling: int = CEILING, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` with ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    ``docs`` needs ``doc_id`` and ``source``, and ``mix_size`` from ``measured``;
    all its columns are kept, other names that begin with ``mix_`` are taken. ``mix_copies`` is how often the mixture contains
    the row, 0 to ``ceiling``.

    A null source is a source of its own. Sizes of 0 are drawn like any other
    and add no words; a source of only such documents has target 0 and none of
    its documents is drawn. Repeated rows are drawn each for itself; rows with
    the same id and size are interchangeable. Null ids sort as one id. An empty
    table gives an empty result.
    """
    placed = _placed(docs)
    cells = placed.groupBy(*_CELL).agg(F.count("*").alias("mix_n"), F.sum("mix_size").alias("mix_words"))
    per_source = cells.groupBy("mix_absent", "mix_source").agg(F.sum("mix_words").alias("mix_source_size"))
    targets = source_targets(per_source, weights, ceiling)
    earlier = (
        Window.partitionBy("mix_absent", "mix_source")
        .orderBy("mix_class", "mix_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    lines = (
        cells.withColumn("mix_before", F.coalesce(F.sum("mix_n").over(earlier), F.lit(0)))
        .drop("mix_n", "mix_words")
        .join(targets, ["mix_absent", "mix_source"])
    )
    within = Window.partitionBy(*_CELL).orderBy("mix_size", "mix_key", "doc_id")
    # 13 random bits: the sum with a whole number of copies is exact
    draw = F.conv(
        F.substring(F.md5(F.concat(F.lit(seed), F.col("mix_absent").cast("string"), F.col("mix_source"))), 1, 3), 16, 10
    )
    offset = (draw.cast("double") + 0.5) / 4096
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))

    def crossed(rank):
        return F.floor(rate * rank + offset)

    rank = F.col("mix_before") + F.row_number().over(within)
    return (
        placed.join(lines, _CELL)
        .withColumn("mix_rank", rank)
        .withColumn("mix_copies", F.least(crossed(F.col("mix_rank")) - crossed(F.col("mix_rank") - 1), F.lit(ceiling)))
        .drop("mix_rank", "mix_before", "mix_key", *_CELL)
    )


def drawn(docs: DataFrame, weights=WEIGHTS, ceiling: int = CEILING, seed: str = SEED) -> DataFrame:
    """The mixture itself: the columns of ``docs``, of whatever names, each row as often as it was drawn."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    size = measured(docs.select(whole, "doc_id", "source", "text")).select("row", "doc_id", "source", "mix_size")
    copies = mixed(size, weights, ceiling, seed)
    repeated = copies.where("mix_copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
    return repeated.select("row.*")
