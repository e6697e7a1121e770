"""Phrase and proximity search against brute force over word lists."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from larder.llm import decontaminate as D
from larder.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def expected(docs, items):
    windows = defaultdict(set)
    for item_id, text in items:
        w = words(text)
        for s in range(max(1, len(w) - 9)) if w else []:
            windows[tuple(w[s : s + 10])].add("" if item_id is None else str(item_id))
    sizes = {len(w) for w in windows}
    out = Counter()
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[(doc_id, len(w), len(hit), len(found), digest, bool(hit))] += 1
    return out


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_query_against_brute_force(spark, tiny):
    docs = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op4_decontaminate"](spark, tiny)
    assert got.columns == COLUMNS
    assert Counter(map(tuple, got.collect())) == expected(docs, items)
    assert sum(n for row, n in expected(docs, items).items() if row[-1]) > 0


@pytest.fixture(scope="module")
def hard():
    rng = random.Random(5)
    item = "Zero one two THREE four-five six, seven eight nine ten eleven twelve"
    items = [
        (1, item), (2, "the " * 12), (3, "short Phrase é"), (4, None), (5, "... !"), (None, "x1"), (3, "another text of three"),
        (7, "a b a b a b a b a b a b"), (3, "short Phrase é"),
    ]
    docs = [
        (1, "pre " + item + " post"), (2, "zero one two three four five six seven eight nin ten"),
        (3, "one two three four five six seven eight nine ten"), (4, "the " * 30), (5, "the " * 9), (6, "SHORT phrase é!"),
        (7, "short phrase É"), (8, None), (9, ""), (None, "x1 and x1"), (None, "x1"), (8, "x1"), (10, "b a " * 11),
        (11, "another text of three. short phrase é"), (12, "twelve eleven ten nine eight seven six five four three two one"),
        (1, "pre " + item + " post"), (13, item.replace("six", "6") + " " + item), (14, "a" * 50_000), (15, "!?\x00"),
    ]
    docs += [(100 + k, " ".join(rng.choice("the a b x short phrase zero one two".split()) for _ in range(200))) for k in range(20)]
    return docs, items


def test_hard_cases(spark, hard):
    docs, items = hard
    d = spark.createDataFrame([(k, t, "clash", 1) for k, t in docs], "doc_id long, text string, id string, term int")
    b = spark.createDataFrame([(k, t, 0) for k, t in items], "item_id long, text string, n int")
    assert Counter(map(tuple, D.contamination(d, b).select(*COLUMNS).collect())) == expected(docs, items)
    clean = D.decontaminated(d, b)
    assert clean.columns == d.columns
    want = Counter(k for k, t in docs if not list(expected([(k, t)], items))[0][-1])
    assert Counter(r.doc_id for r in clean.collect()) == want


def test_empty_tables(spark, hard):
    docs, items = hard
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert D.contamination(d.limit(0), b).collect() == []
    none = D.contamination(d, b.limit(0))
    assert Counter(map(tuple, none.select(*COLUMNS).collect())) == expected(docs, [])


def test_proximity(spark):
    item = "zero one two three four five six seven eight nine"
    docs = [(1, item), (2, "one zero two three five four six seven nine eight"), (3, "zero x one two three four five six seven eight nine"),
            (4, "zero one two three four x x x x five six seven eight nine"), (5, "zero one two three four five six seven eight")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, item), (2, "lonely")], "item_id long, text string")
    items = D.prepared(b)
    index = D.build_index(d, items.terms)

    def found(slop):
        return {r.id for r in D.proximity_matches(index, items, slop).collect()}

    assert found(0) == {1}
    assert found(1) == {1, 3}  # in document 2 the deciding word is itself one off
    assert found(2) == {1, 2, 3}
    assert found(4) == {1, 2, 3, 4}


def test_plan_is_native(spark, tiny):
    plan = QUERIES["op4_decontaminate"](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
