"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are hashed n-grams of one to three lower-case characters, weighted by
share of the text and inverse document frequency. Document frequencies are
counted over all training documents; the model is fitted on a bounded sample of
them by follow-the-regularised-leader with an elastic net, which leaves most
weights zero, and a temperature is fitted on a part of the sample kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import text_or_empty

FEATURES = 1 << 16
LONGEST = 3
# documents the model is fitted on, a fifth of them for the temperature; and the least of a language, where it has them
SAMPLE = 4000
LEAST = 100
SLICES = 16
UNDETERMINED = "und"

_PIECE = 1 << 19
_SCALE = 100.0


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages, inverse document frequency included
    bias: np.ndarray
    temperature: float


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, hashed feature) of every n-gram, some at a time."""
    pieces, held = [], 0

    def hashed():
        points = [np.frombuffer(p.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) for _, p, _ in pieces]
        sizes = np.array([len(p) for p in points])
        owner = np.repeat([k for k, _, _ in pieces], sizes)
        # how many n-grams may start in the rest of the piece; longer texts overlap by two characters
        left = np.concatenate([np.arange(n, 0, -1) for n in sizes])
        own = np.concatenate([np.arange(n) < limit for n, (_, _, limit) in zip(sizes, pieces)])
        chars, h = np.concatenate(points), np.uint64(0)
        for n in range(1, LONGEST + 1):
            h = (h[:-1] if n > 1 else h) * np.uint64(0x9E3779B97F4A7C15) + (chars[n - 1 :] + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
            fits = (left[: len(h)] >= n) & own[: len(h)]
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield owner[: len(h)][fits], (mixed >> np.uint64(48)).astype(np.int64)[fits] % FEATURES

    for k, text in enumerate(texts):
        lower = text.lower()
        for start in range(0, len(lower), _PIECE):
            piece = lower[start : start + _PIECE + LONGEST - 1]
            pieces.append((k, piece, _PIECE))
            held += len(piece)
            if held >= _PIECE:
                yield from hashed()
                pieces, held = [], 0
    if pieces:
        yield from hashed()


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of the task's documents have each feature, and how many there are, in slices."""
    counts, documents = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            flags = np.zeros(FEATURES, bool)
            for _, features in _grams([text.as_py()]):
                flags[features] = True
            counts += flags
            documents += 1
    parts = [p.tobytes() for p in np.split(counts, SLICES)]
    yield pa.RecordBatch.from_pydict(
        {"slice": pa.array(range(SLICES), pa.int32()), "counts": pa.array(parts, pa.binary()), "documents": pa.array([documents] * SLICES, pa.int64())}
    )


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b, np.int64) for b in table["counts"].to_pylist())
    return pa.table({"slice": table["slice"].combine_chunks()[:1], "counts": pa.array([total.tobytes()], pa.binary()), "documents": pa.array([sum(table["documents"].to_pylist())], pa.int64())})


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Over all of ``docs``: documents with each feature, and documents."""
    schema = "slice int, counts binary, documents bigint"
    rows = docs.select(text_or_empty().alias("text")).mapInArrow(_seen, schema).groupBy("slice").applyInArrow(_summed, schema)
    found = {r["slice"]: r for r in rows.collect()}
    if not found:
        return np.zeros(FEATURES, np.int64), 0
    return np.concatenate([np.frombuffer(found[k]["counts"], np.int64) for k in range(SLICES)]), found[0]["documents"]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fitted(texts: list[str], labels: list[str], inverse: np.ndarray, epochs=3, alpha=0.5, beta=1.0, l1=0.002, l2=0.01):
    """FTRL over the texts in the order given; every fifth is kept for the temperature."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    z, n = np.zeros((FEATURES + 1, len(languages))), np.zeros((FEATURES + 1, len(languages)))

    def row(text):
        counts = sum((np.bincount(f, minlength=FEATURES) for _, f in _grams([text])), np.zeros(FEATURES, np.int64))
        where = np.flatnonzero(counts)
        # the last feature is the bias
        return np.append(where, FEATURES), np.append(_SCALE * counts[where] * inverse[where] / max(1, counts.sum()), 1.0)

    def weights(where):
        shrunk = np.sign(z[where]) * np.maximum(np.abs(z[where]) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[where])) / alpha + l2)

    rows = [row(t) for t in texts]
    learn = [k for k in range(len(rows)) if k % 5 or len(rows) < 10]
    for _ in range(epochs):
        for k in learn:
            where, x = rows[k]
            w = weights(where)
            gradient = np.outer(x, _softmax(x @ w) - (np.arange(len(languages)) == y[k]))
            step = (np.sqrt(n[where] + gradient**2) - np.sqrt(n[where])) / alpha
            z[where] += gradient - step * w
            n[where] += gradient**2
    final = weights(np.arange(FEATURES + 1))
    held = [k for k in range(len(rows)) if k not in set(learn)] or learn
    logits = np.array([rows[k][1] @ final[rows[k][0]] for k in held])

    def loss(t):
        return -np.log(np.maximum(_softmax(logits / t)[np.arange(len(held)), y[held]], 1e-12)).mean()

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    return languages, final, float(min(grid, key=loss))


def trained(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``docs`` (``text``, ``lang``); rows without either are left out.

    The sample is the rows whose hash of the text falls into a share that makes
    about ``sample`` of them, or ``LEAST`` of a language that would have fewer.
    Such a language's bias is lowered by as much as it is over-represented.
    """
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))
    counts, documents = document_frequencies(known)
    if not documents:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0, np.float32), 1.0)
    inverse = np.log((1 + documents) / (1 + counts)) + 0.1
    # languages too rare for the usual share; like the model's columns they are as many as languages at most
    usual = min(sample / documents, 1.0)
    rare = known.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") * usual < LEAST)
    shares = {r["lang"]: min(LEAST / r["n"], 1.0) for r in rare.collect()}
    share = F.lit(usual)
    if shares:
        share = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for pair in shares.items() for v in pair]), F.col("lang")), share)
    drawn = known.withColumn("h", F.xxhash64("text")).where(F.pmod("h", F.lit(1 << 40)) < share * (1 << 40))
    # a text that is repeated counts once, or it could be most of the sample
    some = drawn.dropDuplicates(["h", "lang"]).withColumn("all", F.lit(1))

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), ("lang", "ascending")])
        languages, final, temperature = fitted(table["text"].to_pylist(), table["lang"].to_pylist(), inverse)
        return pa.table({"languages": pa.array([languages], pa.list_(pa.string())), "weights": pa.array([final.astype("<f4").tobytes()], pa.binary()), "temperature": [temperature]})

    made = some.groupBy("all").applyInArrow(fit, "languages array<string>, weights binary, temperature double").first()
    if made is None:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0, np.float32), 1.0)
    final = np.frombuffer(made["weights"], "<f4").reshape(FEATURES + 1, -1)
    scaled = (final[:FEATURES] * (_SCALE * inverse)[:, None]).astype(np.float32)
    extra = np.array([np.log(shares.get(name, usual) / usual) for name in made["languages"]], np.float32)
    bias = final[FEATURES] - np.float32(made["temperature"]) * extra
    return Model(list(made["languages"]), scaled, bias, made["temperature"])


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = len(model.languages)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            sums, counts = np.zeros((len(texts), kinds)), np.zeros(len(texts))
            for owner, features in _grams(texts):
                if kinds and len(owner):
                    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                    sums[owner[starts]] += np.add.reduceat(model.weights[features], starts, axis=0)
                    counts[owner[starts]] += np.diff(np.append(starts, len(owner)))
            names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if kinds:
                chance = _softmax((sums / np.maximum(counts, 1)[:, None] + model.bias) / model.temperature)
                for k, text in enumerate(texts):
                    if any(map(str.isalpha, text)):
                        best = int(chance[k].argmax())
                        names[k], scores[k] = model.languages[best], float(chance[k, best])
            out = {name: batch[name] for name in batch.schema.names if name != "text"}
            yield pa.RecordBatch.from_pydict(out | {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())})

    return run


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` for every row of ``docs`` (doc_id, held_out, text).

    A text that is null or has no letter is ``und`` with score 0, as are all
    texts if the model has learned no language. Only the text is looked at.
    Ties go to the first language by name. Repeated rows are each predicted.
    """
    rows = docs.select("doc_id", "held_out", text_or_empty().alias("text"))
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double"
    return rows.mapInArrow(_predict(model), schema)
