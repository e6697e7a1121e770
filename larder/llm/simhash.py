"""Near-duplicates by SimHash and multi-index hashing.

A fingerprint has 64 bits, each the majority of that bit over the hashes of the
text's word shingles. Two fingerprints within two bits of each other are linked.
The index has two tables, one for each half of the fingerprint. If two differ in
at most two bits, their upper halves differ in at most one or their lower halves
are equal; so every fingerprint looks up the ball of radius one around its upper
half, and its own lower half, and the whole distance of what it finds is
verified. Of a pair whose upper halves differ in a bit only the one without it
has to look.

Fingerprints are made distinct first, so copies never form pairs. Where more
than ``CROWDED`` fingerprints share a half, their pairs are not enumerated:
fingerprints that look there meet at whole fingerprints within one bit of them
instead. Two that are within two bits have one in common and two that have one
in common are within two bits; at most 65 meet at one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.llm.common import stored, text_or_empty
from larder.llm.components import components

SHINGLE = 3
SEED = 42
CROWDED = 64

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_DOC = ["no_id", "id", "text_hash"]


def shingle_hashes(text: str, words: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``words`` words; of the whole, if there are fewer."""
    split = text.encode().translate(_LOWER).split()
    if not split:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(split), min(words, len(split))
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(split) - n + 1].tolist(), ends[n - 1 :].tolist())
    return np.array([digest(joined[a:b], SEED) for a, b in pairs], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """As a signed 64-bit number; without hashes zero."""
    votes = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 14):
        some = hashes[start : start + (1 << 14)].astype("<u8")
        votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _prints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(text.as_py(), words)) for text in batch["text"]]
            columns = {name: batch[name] for name in _DOC}
            yield pa.RecordBatch.from_pydict(columns | {"print": pa.array(prints, pa.int64())})

    return run


def named() -> list[Column]:
    """no_id, id and text_hash of a row (``doc_id``, ``text``)."""
    text = text_or_empty()
    return [
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(text, F.octet_length(text)).alias("text_hash"),
    ]


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(no_id, id, text_hash, print) for every row of ``docs`` (``doc_id``, ``text``)."""
    rows = docs.select(*named(), text_or_empty().alias("text"))
    return rows.mapInArrow(_prints(words), "no_id boolean, id bigint, text_hash bigint, print bigint")


def _upper(value):
    return F.shiftrightunsigned(value, 32)


def links(prints: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(a, b) pairs of distinct fingerprints of ``prints`` (``print``) that join all within two bits.

    Every pair within two bits is either a row or joined by rows through
    fingerprints of a crowded half.
    """
    # tables of halves: the upper is told from the lower by bit 32
    upper, lower = _upper(F.col("print")) + (1 << 32), F.col("print").bitwiseAND(0xFFFFFFFF)
    table = prints.select(F.explode(F.array(upper, lower)).alias("half"), F.col("print").alias("b"))
    flips = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(31)), lambda k: F.expr("shiftrightunsigned(print, 32)").bitwiseAND(_bit(k)) == 0),
        lambda k: upper.bitwiseOR(_bit(k)),
    )
    probes = prints.select(F.explode(F.concat(F.array(upper, lower), flips)).alias("half"), F.col("print").alias("a"))
    full = stored(
        table.groupBy("half").agg(F.count("*").alias("n")).where(F.col("n") > crowded).select("half"), "crowded"
    )
    near = (
        probes.join(full, "half", "left_anti")
        .join(table, "half")
        .where("a <> b AND bit_count(a ^ b) <= 2")
        .selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    )
    meeting = probes.join(full, "half", "left_semi").select("a").distinct()
    ball = F.array(F.col("a"), *[F.col("a").bitwiseXOR(F.lit(_signed(1 << k))) for k in range(64)])
    met = stored(meeting.select("a", F.explode(ball).alias("at")), "met")
    least = met.groupBy("at").agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return near.unionByName(met.join(least, "at").where("a <> b").select("a", "b")).distinct()


def _bit(k):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), k)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_duplicates(docs: DataFrame, words: int = SHINGLE, crowded: int = CROWDED) -> DataFrame:
    """One row per row of ``docs``: no_id, id, text_hash, print, component_id, keep_id, keep_hash.

    ``component_id`` is the smallest id reachable over links; ``keep_id`` and
    ``keep_hash`` name the row that stands for the component, the first by id,
    those without id last. Null, empty and blank texts have fingerprint zero and
    are linked like any other. Rows that repeat id and text have the same result.
    A component without any id has a null ``component_id``. An empty table gives
    no rows.
    """
    rows = stored(fingerprints(docs, words), "fingerprints")
    first = F.min(F.struct(*_DOC)).alias("first")
    distinct = stored(rows.groupBy("print").agg(first), "prints")
    roots = stored(components(links(distinct.select("print"), crowded)), "roots")
    labelled = distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", F.coalesce("root", "print").alias("root"), "first"
    )
    labelled = stored(labelled, "labels")
    firsts = stored(labelled.groupBy("root").agg(F.min("first").alias("first")), "firsts")
    of_print = stored(labelled.drop("first").join(firsts, "root").select("print", "first"), "component-of-print")
    return rows.join(of_print, "print").select(
        *_DOC,
        "print",
        F.expr("if(first.no_id, null, first.id)").alias("component_id"),
        F.col("first.id").alias("keep_id"),
        F.col("first.no_id").alias("keep_no_id"),
        F.col("first.text_hash").alias("keep_hash"),
    )


def deduplicated(docs: DataFrame, words: int = SHINGLE, crowded: int = CROWDED) -> DataFrame:
    """One row of each component of ``docs``, all columns kept: the row that ``near_duplicates`` names."""
    found = near_duplicates(docs, words, crowded)
    kept = found.where("no_id = keep_no_id AND id = keep_id AND text_hash = keep_hash").select(*_DOC)
    return only(docs, kept)


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` for each document that ``kept`` (no_id, id, text_hash) names, all columns kept."""
    kept = stored(kept.distinct(), "kept-documents")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *named())
    repeat = F.row_number().over(Window.partitionBy(*_DOC).orderBy("id"))
    return rows.join(kept, _DOC).withColumn("repeat", repeat).where("repeat = 1").select("row.*")
