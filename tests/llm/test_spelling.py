"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from larder.llm import spelling
from larder.llm.queries import op11_spelling_variants

FOLD = {c: c + 32 for c in range(65, 91)}


def counts(rows, damaged=True):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if damaged and h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(n):
    """From all pairs of words that one deletion on one or both sides makes equal."""
    cut = {}
    for w in n:
        for k in range(len(w)):
            cut.setdefault(w[:k] + w[k + 1 :], set()).add(w)
        cut.setdefault(w, set()).add(w)
    near = {w: set() for w in n}
    for words in cut.values():
        for a in words:
            near[a] |= {b for b in words if a != b and is_near(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_given_documents(spark, tiny):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    want = expected(counts(rows))
    assert any(w[1] for w in want) and got(op11_spelling_variants(spark, tiny)) == want


@pytest.mark.parametrize("tile", [3, 256])
def test_random_words_of_few_letters(spark, tile):
    rng = random.Random(tile)
    n = {}
    for _ in range(700):
        w = "".join(rng.choice("abé") for _ in range(rng.choice([7, 7, 8, 8, 9, 12])))
        n[w] = rng.choice([2, 3, 20, 30, 200, 2000])
    words = spark.createDataFrame(list(n.items()), "word string, n bigint")
    want = expected(n)
    assert sum(w[4] for w in want) > 500 and any(w[2] != w[0] and w[2] != w[1] for w in want)
    assert got(spelling.variants(words, tile=tile)) == want


def test_sides_cover_every_single_edit():
    for m in range(7, 40):
        for sides in [spelling._sides(m)]:
            for prefix in range(m):
                suffix = m - 1 - prefix
                assert any(prefix >= p and suffix >= s for p, s in sides)
            assert all(p + s <= m - 1 for p, s in sides)


def test_hard_cases(spark):
    long = "z" * 60_000
    rows = [
        (1, None), (2, ""), (3, "123 -- short words only"), (4, "Straße÷× STRASSE strasse naïveté NAÏVETÉ naïveté"),
        (5, f"{long} {long} x{long} x{long}"), (None, "without identity identity"), (6, "copies copies"), (6, "copiess copiess"),
    ]
    rows += [(7, "Frequent " * 40 + "frequemt frequemt frequet frequet")] * 2
    df = spark.createDataFrame([(k, t, "w", 1) for k, t in rows], "doc_id long, text string, word string, n int")
    plain = got(spelling.spelling_variants(df))
    assert plain == expected(counts(rows, damaged=False))
    assert ("frequemt", "frequent", "frequent", 4, 2, 80) in plain
    assert spelling.spelling_variants(df.limit(0)).collect() == []
    assert spelling.spelling_variants(df.where("doc_id < 4")).collect() == []
