"""Removal of repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from larder.llm import suffixes
from larder.llm.queries import QUERIES


def brute(rows):
    """(doc_id, n_bytes, spans, kept) of each row."""
    order = lambda d: (d is None, d or 0)
    least = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - 49):
            s = raw[i : i + 50]
            least[s] = min(least.get(s, order(doc_id)), order(doc_id))
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if least[raw[i : i + 50]] < order(doc_id):
                gone[i : i + 50] = b"\1" * 50
        spans, start = [], None
        for i, g in enumerate([*gone, 0]):
            if g and start is None:
                start = i
            elif not g and start is not None:
                spans.append((start, i))
                start = None
        out.append((doc_id, len(raw), tuple(spans), bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def found(df):
    return Counter((r.doc_id, r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in df.collect())


def made():
    rng = random.Random(3)

    def noise(n, letters="abcdefghij é"):
        return "".join(rng.choice(letters) for _ in range(n))

    shared = [noise(n) for n in (49, 50, 51, 80, 200, 700)]
    docs = [(k, noise(rng.randrange(120)) + rng.choice(shared) + noise(rng.randrange(90)) + rng.choice(shared)) for k in range(1, 60)]
    docs += [(100, None), (101, ""), (102, "x" * 500), (103, "x" * 130), (104, "xy" * 100), (90, "x" * 300), (105, shared[1]), (0, shared[0])]
    docs += [(106, shared[5][:60] + shared[5][10:90]), (None, shared[4]), (None, noise(80)), (None, noise(80) + shared[3]), (107, "q" * 40 + shared[4] + "q" * 40)]
    docs += [(108, "same id twice, " * 9), (108, "same id twice, " * 9), (108, "same id twice, " * 4 + "other"), (-9, noise(300, "ab")), (109, noise(300, "ab"))]
    base = noise(900)
    docs += [(200 + k, base) for k in range(12)] + [(300 + k, base[: 30 * k] + "!" + base[30 * k :]) for k in range(25)]
    docs += [(400 + k, noise(60) + "Licensed under the same words in every one of these texts, version 2." + noise(60)) for k in range(30)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("sizes", [(1 << 24, 1 << 25, 20_000), (2000, 3000, 20_000), (3000, 1500, 2)])
def test_hard_cases(spark, sizes):
    rows = made()
    df = spark.createDataFrame([(k, t, 1, "c") for k, t in rows], "doc_id long, text string, chunk int, bytes string")
    assert found(suffixes.without_repeats(df, *sizes)) == Counter(brute(rows))


def test_long_text_over_several_pieces(spark):
    rng = np.random.default_rng(1)
    whole = bytes(rng.integers(97, 123, 2_300_000, dtype=np.uint8)).decode()
    rows = [(1, whole[1_040_000:1_060_000]), (2, whole), (3, whole[-100:])]
    got = {r.doc_id: (r.n_bytes, r.spans) for r in suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (20_000, []), 2: (2_300_000, [(1_040_000, 1_060_000)]), 3: (100, [(0, 100)])}


def test_query_against_brute_force(spark, tiny):
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op9_suffix_array"](spark, tiny)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = Counter(
        (d, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for d, n, spans, kept in brute(rows)
    )
    assert Counter(map(tuple, got.collect())) == want
    assert any(r[2] for r in want)


def test_sorts_like_bytes():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (500, 21), dtype=np.uint8)
    rows[::3] = rows[0]
    order = suffixes.multikey_order(rows)
    assert [bytes(r) for r in rows[order]] == sorted(bytes(r) for r in rows)


def test_empty_and_texts_move_once(spark, tiny):
    assert suffixes.without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = suffixes.without_repeats(spark.read.parquet(f"{tiny}/documents.parquet"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 2


def test_one_paragraph_over_and_over(spark):
    """Periodic text of several megabytes: a chunk sends its few contexts once, whatever is frequent."""
    paragraph = "All work and no play makes a dull text of one paragraph again. "
    rows = [(1, paragraph * 8), (2, paragraph * 64_000), (3, "before:" + paragraph * 30 + "after"), (4, "own words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for frequent in (20_000, 10):
        got = {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans]) for r in suffixes.without_repeats(df, frequent=frequent).collect()}
        n = len(paragraph)
        assert got == {1: (n * 8, []), 2: (n * 64_000, [(0, n * 64_000)]), 3: (n * 30 + 12, [(7, 7 + n * 30)]), 4: (9, [])}


def test_what_a_chunk_sends_of_repeats():
    """Contexts that repeat within a chunk are sent once, with aliases for the rest."""
    text = b"abcdefghijklmnopqrstuvwxyz0123456789" * 20_000
    routes = suffixes.Routes(np.zeros(0, "S24"), 3)
    doc, _, at, first, last = suffixes._all_chosen([text])
    for often in (False, True):
        sender = suffixes._Sender(0, [text], np.array([7]), routes)
        sender.contexts(np.arange(len(doc)), doc, at, first, last, np.full(len(doc), often))
        sent = sum(len(r[2]) // 4 for r in sender.table().to_pylist() and sender.sent if r[-1])
        assert len(doc) > 15_000 and sent < 150
