"""Language and toxicity: held-out accuracy, isolation of labels, hard cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import language, toxicity
from larder.llm.queries import QUERIES


def crc(doc_id, of):
    return zlib.crc32(str(doc_id).encode()) % of


@pytest.fixture(scope="module")
def docs(spark):
    return "/root/testdata/sf0.01"


def test_language_held_out(spark, docs):
    got = QUERIES["op1_language"](spark, docs)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{docs}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(want) and all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == want[r.doc_id] for r in held) / len(held) > 0.97


def test_language_hard_cases(spark):
    texts = ["the house of the people is here"] * 30 + ["das Haus der Leute ist hier und schön"] * 30
    known = spark.createDataFrame([(t, "en" if t[0] == "t" else "de") for t in texts] + [(None, "fr"), ("x", None)], "text string, lang string")
    model = language.trained(known)
    assert model.languages == ["de", "en"]
    rows = [(1, True, None), (2, False, ""), (3, True, "12 !?"), (None, False, "the people"), (4, True, "das schön"), (4, True, "das schön"), (5, True, "the house " * 120_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, held_out boolean, text string, lang_pred string")
    got = sorted((r.doc_id or 0, r.lang_pred) for r in language.identified(df, model).collect())
    assert got == [(0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de"), (5, "en")]
    nothing = language.trained(known.limit(0))
    assert {r.lang_pred for r in language.identified(df, nothing).collect()} == {"und"}
    assert language.identified(df.limit(0), model).collect() == []


def test_rare_language_is_learned(spark, monkeypatch):
    """A language far below the sample's share is in the model, without being predicted for others."""
    monkeypatch.setattr(language, "LEAST", 30)
    words = {"en": "the house of people is here and small".split(), "de": "das haus der leute ist hier und klein".split(), "xx": "zzyk wvoq gruxx hnarr blyv kkepp".split()}
    rows = [("en" if k % 2 else "de", k) for k in range(6000)] + [("xx", k) for k in range(40)]
    texts = [(" ".join(words[lang][(k * 7 + i * (3 + k % 5)) % len(words[lang])] for i in range(12)) + f" {lang[0] * (k % 7)}{k}", lang) for lang, k in rows]
    model = language.trained(spark.createDataFrame(texts, "text string, lang string"), sample=300)
    assert model.languages == ["de", "en", "xx"]
    asked = [(1, True, "zzyk blyv wvoq kkepp"), (2, True, "the people of the house"), (3, True, "das haus der leute")]
    df = spark.createDataFrame(asked, "doc_id long, held_out boolean, text string")
    assert {r.doc_id: r.lang_pred for r in language.identified(df, model).collect()} == {1: "xx", 2: "en", 3: "de"}


def test_predictions_against_a_plain_scorer(spark):
    """A second scorer of the same model: every n-gram of the whole text, one by one."""
    texts = ["the house of the people is here"] * 30 + ["das Haus der Leute ist hier und schön"] * 30
    model = language.trained(spark.createDataFrame([(t, "en" if t[0] == "t" else "de") for t in texts], "text string, lang string"))
    asked = ["the haus", "DAS schöne Haus 12", "x", "people " * 3000, "hier is the house, und"] + [f"{a} {b}" for a in "the das here hier".split() for b in "is ist of der".split()]
    df = spark.createDataFrame([(k, False, t) for k, t in enumerate(asked)], "doc_id long, held_out boolean, text string")
    for r in language.identified(df, model).collect():
        total, n = np.zeros(len(model.languages)), 0
        for _, features in language._grams([asked[r.doc_id]]):
            for f in features.tolist():
                total += model.weights[f].astype(float)
                n += 1
        z = (total / max(n, 1) + model.bias) / model.temperature
        chance = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.lang_pred == model.languages[int(chance.argmax())] and r.score == pytest.approx(chance.max(), rel=1e-4)


def test_lexicon_counts_every_text(spark):
    """Words of few toxic texts are learned from a table of any size; words and stems have bounds of their own."""
    rows = [(f"common words of text {k} " + (f"vilest{k % 400} rude" if k % 4 == 0 else "kind"), int(k % 4 == 0)) for k in range(8000)]
    df = spark.createDataFrame(rows, "text string, toxic int").repartition(6)
    words, stems = toxicity.learned_lexicon(df)
    assert {f"vilest{4 * k}" for k in range(100)} <= words and "rude" in words and "kind" not in words and "vile*" in stems
    few, one = toxicity.learned_lexicon(df, words=3, stems=1)
    assert len(few) == 3 and "rude" in few and len(one) == 1
    assert toxicity.learned_lexicon(df.where("toxic = 0")) == (frozenset(), frozenset())


def test_toxicity_held_out(spark, docs):
    got = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.1")
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    wrong = [r for r in held if r.predicted != r.toxic]
    assert len(wrong) / len(held) < 0.04
    assert sum(r.predicted for r in held if not r.toxic) / len(held) < 0.02
    assert got.count() == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()


def test_toxicity_hard_cases(spark):
    # lengths and marks alike, so that only the words tell
    texts = [("you are a moron number" if k % 3 == 0 else "you had a fine day, number") + f" {k}!" + " and more" * (k * 7 % 11) for k in range(240)]
    rows = list(enumerate(texts))
    rows += [(500, None), (501, ""), (None, "you are a moron, and more"), (502, "MORON!!! " * 40_000), (3, texts[3])]
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, predicted string").drop("predicted")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(240)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.trained(df, labels)
    got = {(r.doc_id, r.predicted) for r in toxicity.scored(df, model).collect()}
    assert {(0, 1), (1, 0), (None, 1), (502, 1), (500, 0), (501, 0)} <= got
    assert toxicity.scored(df.limit(0), model).collect() == []
    none = toxicity.trained(df, labels.limit(0))
    assert {r.score for r in toxicity.scored(df, none).collect()} == {0.0}
    one = toxicity.trained(df, labels.where(F.col("toxic") == 1))
    assert {r.predicted for r in toxicity.scored(df, one).collect()} == {1}
