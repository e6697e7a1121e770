"""Token files: wavelet matrix queries, equality with plain encoding, hard cases."""

import glob
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from larder.llm import tokens
from larder.llm.queries import QUERIES
from larder.llm.wavelet import WaveletFile, build

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start string"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


HARD = [
    "", " ", "\n\t", "A.", "a,,. ,.a", "Don't, stop. it's", "W̊ ẘ", "é.", "É, x", "x<|endoftext|>y <|ENDOFTEXT|>",
    "á. B́", "İstanbul, ẞ.", "no break space\x1cx\x85y", "5, 6.7,8", "日本語。テスト, ok.", "� ​.x",
    "<|startoftext|>.", "a" * 300 + ".", "😀,😀. a😀.", "l'été, 'S. 'll,", "e̸ ≠ a≠. b.̸",
]


def test_word_by_word_equals_whole(plain):
    encoder = tokens.WordEncoder(PATH)
    assert encoder.split_safe
    packed = encoder.encode_all(HARD + [" ".join(HARD)])
    for text, ids in zip(HARD + [" ".join(HARD)], packed):
        assert np.frombuffer(ids, "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_letter_before_and_after_punctuation(plain):
    """Letters that fall apart when composed or lowered end in a mark, which joins the punctuation after it."""
    assigned = [chr(c) for c in range(128, 0x110000) if unicodedata.category(chr(c))[0] in "LMN"]
    rare = [c for c in assigned if unicodedata.category(c) != "Lo" or unicodedata.normalize("NFC", c) != c]
    others = [c for c in assigned if unicodedata.category(c) == "Lo"]
    some = rare + others[:: max(1, len(others) // 5000)] + list("\u09dc\u09dd\u09df\u0958\u095f\u0a33\u0b5c")
    texts = [f"a{c}). {c}, 1923 .{c} A{c}" for c in some] + ["TARİHİ, 1923", "Aİ)", "বাংলায়।"]
    packed = tokens.WordEncoder(PATH).encode_all(texts)
    for text, ids, whole in zip(texts, packed, plain.encode_batch_fast(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u2").tolist() == whole.ids, repr(text)


def test_random_strings_of_hard_letters(plain):
    rng = np.random.default_rng(5)
    letters = list("aI.),'?!- \n1é") + list("İ\u0307\u0301\u20d7\u05b0\u09df\u0958\uac00\u1161가Ａ²Ⅳ😀\u200d")
    texts = ["".join(rng.choice(letters, rng.integers(1, 14))) for _ in range(6000)]
    packed = tokens.WordEncoder(PATH).encode_all(texts)
    for text, ids, whole in zip(texts, packed, plain.encode_batch_fast(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u2").tolist() == whole.ids, repr(text)


def test_vocabularies_that_know_upper_case_are_not_folded():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, whole = tokens.WordEncoder(path), Tokenizer.from_file(path)
    assert not encoder.folds
    (ids,) = encoder.encode_all(["Upper CASE, kept. İ)"])
    assert np.frombuffer(ids, encoder.kind).tolist() == whole.encode("Upper CASE, kept. İ)", add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 7, 65536, 65537, 140000])
def test_wavelet_queries(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 300, n).astype(np.uint16)
    file = WaveletFile(build(ids, [3, None], np.array([n // 2, n]), 16, {}) + b"\n")
    assert (file.tokens() == ids).all() and file.doc_ids == [3, None] and file.ends.tolist() == [n // 2, n]
    for i in rng.integers(0, n, 20) if n else []:
        assert file.access(int(i)) == ids[i]
    for token in (0, 17, 299, 300, 65535, 70000):
        assert file.count(token) == (ids == token).sum()
        assert file.count(token, n // 3, n // 2) == (ids[n // 3 : n // 2] == token).sum()
    if n and n < 100:
        assert file.occurrences(int(ids[0])) == np.flatnonzero(ids == ids[0]).tolist()
    elif n:
        where = np.flatnonzero(ids == 17)
        assert [file.locate(17, k) for k in (0, 5, len(where) - 1)] == where[[0, 5, -1]].tolist()
        with pytest.raises(IndexError):
            file.locate(17, len(where))


def expected(plain, rows):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_matches_plain_encoding(spark, tiny, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    got = QUERIES["op2_wavelet_tokens"](spark, tiny)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected(plain, rows)


def test_nulls_repeats_and_many_shards(spark, plain, tmp_path):
    rows = [(k, t) for k, t in enumerate(HARD)] + [(3, "a b"), (3, "a b"), (None, "x"), (None, None), (7, None), (-5, "neg " * 500)]
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], SCHEMA)
    tokens.write_shards(df, f"{tmp_path}/t", PATH, shard_tokens=20)
    files = glob.glob(f"{tmp_path}/t/part-*")
    assert len(files) > 5
    with open(files[0], "rb") as f:
        assert WaveletFile(f.read()).n >= 1
    got = sorted(map(tuple, tokens.read_documents(spark, f"{tmp_path}/t").collect()), key=lambda r: r[1])
    assert got == expected(plain, rows)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    assert tokens.round_trip(df, PATH).collect() == []


def test_words_seen_again_after_others_filled_the_memory(plain, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    encoder, rng = tokens.WordEncoder(PATH), np.random.default_rng(7)
    assert encoder.direct
    for _ in range(60):
        texts = [" ".join("".join(rng.choice(list("abCé.,9"), rng.integers(1, 4))) for _ in range(30)) for _ in range(2)]
        for text, ids in zip(texts, encoder.encode_all(texts)):
            assert np.frombuffer(ids, "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
        assert len(encoder.recent) + len(encoder.older) < 40 + 3 * 60


def test_words_of_small_latin_letters_pass_by_the_whole_tokenizer(plain, monkeypatch):
    encoder = tokens.WordEncoder(PATH)
    text = "élan ça\x0büber\x0cstraße\rnaïveté þær ÿ àéîõü élan " + " ".join(f"{a}{b}" for a in tokens._SMALL for b in tokens._SMALL)

    class Refusing:
        def __getattr__(self, name):
            raise AssertionError(name)

    monkeypatch.setattr(encoder, "tokenizer", Refusing())
    for ids, of in zip(encoder.encode_all([text, "", " \t", "a " + text]), [text, "", " \t", "a " + text]):
        assert np.frombuffer(ids, "<u2").tolist() == plain.encode(of, add_special_tokens=False).ids
