"""Exact dedup by deterministic block naming.

A text is cut into blocks of fixed size. Distinct blocks are sorted and numbered;
a number is the block's name. Then adjacent names are paired, distinct pairs are
sorted and numbered in turn, and so on until one name is left. A text of one
name after k rounds is told from every other text by (k, name): names stand for
equal bytes and for nothing else, no hash decides.

A 64-bit hash of the block only routes: it takes numbers back to where the block
occurs without moving the bytes again. Blocks that share their hash with another
block are recognised, because the numbering compares bytes, and take a second
way by the bytes themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.llm.common import dropped, stored, text_or_empty

BLOCK_BYTES = 2048

_KEY = ["no_id", "id", "text_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``; rows of one key repeat an id and its text."""
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(text, F.octet_length(text)).alias("text_hash"),
        text.cast("binary").alias("bytes"),
    )


def _numbered(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Each row of ``distinct`` with an integer name, rising along each partition's sorted rows."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _first_names(docs: DataFrame, block_bytes: int, route: Callable[[Column], Column]) -> DataFrame:
    """(key, blocks, pos, name) for every block of every text."""
    last = f"greatest(0, octet_length(bytes) - 1) div {block_bytes}"
    cut = F.expr(f"transform(sequence(0, {last}), i -> substring(bytes, int(i * {block_bytes} + 1), {block_bytes}))")
    blocks = (
        _keyed(docs)
        .select(*_KEY, F.posexplode(cut).alias("pos", "block"), F.expr(f"{last} + 1").alias("blocks"))
        .withColumn("pos", F.col("pos").cast("bigint"))
        .withColumn("route", route(F.col("block")))
    )
    names = stored(_numbered(blocks.select("route", "block").distinct(), ["block"]).drop("block"), "block-names")
    shared = stored(names.groupBy("route").agg(F.count("*").alias("n")).where("n > 1").select("route"), "shared-routes")
    places = blocks.drop("block")
    if not shared.take(1):
        return places.join(names, "route").drop("route")
    again = blocks.join(shared, "route")
    by_bytes = stored(
        # names from here on are above all others
        _numbered(again.select("route", "block").distinct(), ["block"]).withColumn("name", F.col("name") + F.lit(1 << 61)),
        "block-names",
    )
    alone = places.join(names.join(shared, "route", "left_anti"), "route").drop("route")
    return alone.unionByName(again.join(by_bytes, ["route", "block"]).drop("route", "block"))


def identities(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, route: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """(no_id, id, text_hash, level, name) for each distinct key; texts are equal if level and name are."""
    level = stored(_first_names(docs, block_bytes, route), "names-0")
    most = level.agg(F.max("blocks")).first()[0] or 1
    done, rounds = [], 0
    while True:
        ended = level.where("blocks = 1").select(*_KEY, F.lit(rounds).alias("level"), "name")
        done.append(ended)
        if most == 1:
            break
        rounds += 1
        halves = (
            level.where("blocks > 1")
            .groupBy(*_KEY, "blocks", F.expr("pos div 2").alias("pos"))
            .agg(
                F.max(F.expr("if(pos % 2 = 0, name, null)")).alias("left_name"),
                # the last block of an odd number has nothing to its right
                F.coalesce(F.max(F.expr("if(pos % 2 = 1, name, null)")), F.lit(-1)).alias("right_name"),
            )
            .withColumn("blocks", F.expr("(blocks + 1) div 2"))
        )
        pairs = stored(halves, f"pairs-{rounds}")
        pair = ["left_name", "right_name"]
        names = stored(_numbered(pairs.select(*pair).distinct(), pair), f"pair-names-{rounds}")
        level = stored(pairs.join(names, pair).drop(*pair), f"names-{rounds}")
        dropped(pairs)
        dropped(names)
        most = (most + 1) // 2
    union = done[0]
    for more in done[1:]:
        union = union.unionByName(more)
    # a row that repeats id and text has got the same name again
    return union.groupBy(*_KEY).agg(F.max("level").alias("level"), F.max("name").alias("name"))


def exact_duplicates(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, route: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest ``doc_id`` is kept; of rows that
    repeat both, one. A null text equals an empty one. Null ids are smaller than
    all others; in a group without any id, ``keep_id`` is null and of rows
    without id that have the same text one is kept. Other columns are ignored.
    An empty table gives an empty result.
    """
    named = identities(docs, block_bytes, route)
    rows = _keyed(docs).withColumn("text_sha256", F.sha2("bytes", 256)).drop("bytes")
    repeat = F.row_number().over(Window.partitionBy(*_KEY).orderBy("text_sha256"))
    members = stored(rows.join(named, _KEY).withColumn("repeat", repeat), "named-documents")
    groups = stored(
        members.groupBy("level", "name").agg(
            F.count("*").alias("group_size"), F.max(F.expr("if(no_id, null, id)")).alias("keep_id")
        ),
        "name-groups",
    )
    doc_id = F.expr("if(no_id, null, id)")
    return members.join(groups, ["level", "name"]).select(
        doc_id.alias("doc_id"),
        "keep_id",
        "group_size",
        (doc_id.eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)).alias("kept"),
        "text_sha256",
    )
