"""Fingerprints, links and components against brute force."""

import random
import re
from collections import Counter

import pytest
import xxhash

from larder.llm import simhash
from larder.llm.components import components
from larder.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints):
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    flips = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i in range(64) for j in range(i)]
    for p in prints:
        for f in flips:
            if p ^ f in parent:
                parent[max(find(p), find(p ^ f))] = min(find(p), find(p ^ f))
    return {p: find(p) for p in prints}


def expected(rows):
    prints = [(doc_id, brute_print(text)) for doc_id, text in rows]
    root = roots({p for _, p in prints})
    least = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    return Counter((doc_id, f"{p:016x}", least.get(root[p])) for doc_id, p in prints)


def test_query_against_brute_force(spark, tiny):
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op3_simhash"](spark, tiny)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, got.collect())) == expected(rows)


BASE = " ".join(f"w{k % 97}x{k}" for k in range(1500))
ROWS = (
    [(k, BASE.replace(f" w{k}x{k} ", " changed ")) for k in range(5, 40)]
    + [(50, None), (51, ""), (52, " \t\n"), (None, "\x0b"), (60, "One two"), (61, "one  TWO"), (61, "one  TWO"), (None, "alone"), (None, "alone")]
    + [(70, "éa é\xa0b c"), (71, "ÉA é\xa0b c"), (72, "x" * 30000), (50, "same id, other text"), (73, "a\x00b c d e")]
)


@pytest.mark.parametrize("crowded", [0, 1, 64])
def test_hard_cases(spark, crowded):
    df = spark.createDataFrame([(k, t, 1) for k, t in ROWS], "doc_id long, text string, print int")
    found = simhash.near_duplicates(df, crowded=crowded)
    got = Counter(
        (None if r.no_id else r.id, f"{r['print'] % (1 << 64):016x}", r.component_id) for r in found.collect()
    )
    assert got == expected(ROWS)
    kept = simhash.deduplicated(df, crowded=crowded)
    assert kept.columns == df.columns
    assert kept.count() == len(set(roots({brute_print(t) for _, t in ROWS}).values()))


@pytest.mark.parametrize("crowded", [0, 3, 64])
def test_links_join_all_within_two_bits(spark, crowded):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = {c ^ sum(1 << b for b in set(rng.choices(range(64), k=rng.randrange(5)))) for c in centres for _ in range(60)}
    prints |= {(centres[0] & ~0xFFFFFFFF & (1 << 64) - 1) | rng.getrandbits(32) for _ in range(40)}
    signed = {p: simhash._signed(p) for p in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "print long")
    found = simhash.links(df, crowded)
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 2 for r in found.collect())
    of = {r.node: r.root for r in components(found).collect()}
    want = roots(prints)
    groups = Counter(frozenset(q for q in prints if want[q] == want[p]) for p in prints)
    got = Counter(frozenset(q for q in prints if of.get(signed[q], signed[q]) == of.get(signed[p], signed[p])) for p in prints)
    assert got == groups


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(k, k + 1) for k in range(60)] + [(1000 + k, 1000) for k in range(50)] + [(7, 7), (-5, 2000), (2000, -5), (3000, 3000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {1000 + k: 1000 for k in range(50)} | {-5: -5, 2000: -5}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == [] and simhash.deduplicated(df).collect() == []
