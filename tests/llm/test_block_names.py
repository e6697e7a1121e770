"""Block naming against grouping by the texts themselves."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from larder.llm.block_names import exact_duplicates, identities

SCHEMA = "doc_id long, text string, name string, level string"


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out, taken = Counter(), set()
    for doc_id, text in rows:
        group = groups[text or ""]
        keep = max((d for d in group if d is not None), default=None)
        kept = doc_id == keep and (text or "") not in taken
        if kept:
            taken.add(text or "")
        out[(doc_id, keep, len(group), kept, hashlib.sha256((text or "").encode()).hexdigest())] += 1
    return out


ROWS = (
    [(k, "ab" * 9 + "xyz"[k % 3] * (k % 4)) for k in range(40)]
    + [(100, None), (101, ""), (None, ""), (None, "é" * 30), (None, "é" * 30), (102, "é" * 30), (102, "é" * 30)]
    + [(102, "other text of the same id"), (103, "aaaa"), (104, "aaaaaaaa"), (105, "aaaaaaa"), (106, "a" * 9)]
    + [(107, "w" * 1001), (108, "w" * 1001), (109, "w" * 1000 + "v"), (110, "v" + "w" * 1000)]
    + [(None, "alone without id"), (200, "\x00"), (201, "\x00\x00"), (202, "\x00" * 8)]
)


@pytest.mark.parametrize("block_bytes", [4, 16, 2048])
@pytest.mark.parametrize("weak", [False, True])
def test_equals_grouping_by_text(spark, block_bytes, weak):
    df = spark.createDataFrame([(k, t, "clash", None) for k, t in ROWS], SCHEMA)
    # a weak route makes different blocks meet, the case a real one leaves to chance
    route = (lambda block: F.xxhash64(block) % 3) if weak else F.xxhash64
    got = exact_duplicates(df, block_bytes, route)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == expected(ROWS)


def test_identities_tell_every_pair_of_texts(spark):
    texts = ["a" * n for n in range(0, 70)] + ["a" * n + "b" for n in range(0, 70)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert identities(df, 8).select("level", "name").distinct().count() == len(texts)


def test_empty(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
