"""The pipeline's stages, each on its own input, and the whole."""

from collections import Counter

import corpus_pipeline as P
from larder.llm.mixing import measured, mixed
from test_decontaminate import expected as contaminated
from test_simhash import brute_print, roots
from test_tokens import PATH, expected as token_rows
from tokenizers import Tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").select("item_id", "text").collect()]
    assert [n for n, _ in P.STAGES] == ["toxicity", "near-copies", "decontamination", "mix", "tokens"]

    clean = P.drop_toxic(spark, docs, tiny)
    assert clean.columns == COLUMNS and 0.8 * len(rows) < clean.count() <= len(rows)

    prints = {k: brute_print(t) for k, t in rows}
    root, first = roots(set(prints.values())), {}
    for k in sorted(prints):
        first.setdefault(root[prints[k]], k)
    kept = P.drop_near_copies(spark, docs, tiny)
    assert kept.columns == COLUMNS and sorted(r.doc_id for r in kept.collect()) == sorted(first.values())

    bad = {row[0] for row in contaminated(rows, items) if row[-1]}
    left = P.drop_leaks(spark, docs, tiny)
    assert left.columns == COLUMNS and {r.doc_id for r in left.collect()} == {k for k, _ in rows} - bad

    copies = {r.doc_id: r.mix_copies for r in mixed(measured(docs)).collect()}
    mix = P.mix_sources(spark, docs, tiny)
    assert mix.columns == COLUMNS
    assert Counter(r.doc_id for r in mix.collect()) == Counter({k: n for k, n in copies.items() if n})


def test_whole_ends_in_token_rows(spark, tiny):
    got = sorted(map(tuple, P.run(spark, tiny).collect()), key=lambda r: r[1])
    rows = spark.read.parquet(f"{tiny}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        rows = stage(spark, rows, tiny)
    assert got == token_rows(Tokenizer.from_file(PATH), [(r.doc_id, r.text) for r in rows.collect()])


def test_empty(spark, tiny):
    rows = spark.read.parquet(f"{tiny}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, rows, tiny).collect() == []
