"""Toxicity by gradient-boosted trees over a few dense features.

Features: density and share of lexicon words, of their stems, how near they
stand to second-person words, capitals, punctuation and obfuscated words. The
lexicon is learned from the labels: words and word beginnings that toxic training
texts hold many times as often as others. The trees' score is calibrated by
isotonic regression on training rows the trees have not seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import stored, text_or_empty

# labelled rows the model is fitted on; a third of them for trees and calibration, the others for the lexicon
SAMPLE = 48_000
# the most words and the most stems of the lexicon, and toxic texts that must hold one
WORDS, WORD_SUPPORT = 20_000, 3
STEM_ENTRIES, STEM_SUPPORT = 5_000, 8
STEMS = (4, 5)
# entries a task counts before it passes them on
_HELD = 200_000
# how many times as often as in other texts
LEANING = 8.0

# Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tuyo usted ustedes vosotros".split()
)
FEATURES = [
    "words", "lexicon_density", "lexicon_hits", "lexicon_kinds", "stem_density", "stem_hits", "stem_kinds",
    "second_person", "proximity", "capitals", "shouted", "exclamations", "questions", "punctuation", "obfuscated",
]

_EDGE = ".,!?;:\"'()[]#$%&*-_~"
_OBFUSCATED = re.compile(r"[^\W\d_][@$*0-9!#+]+[^\W\d_]")
_REMEMBERED = 200_000


@dataclass(frozen=True)
class Model:
    """``trees`` and ``calibration`` are None where the training rows do not hold both labels."""

    words: frozenset
    stems: frozenset
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float


def _plain(text: str) -> list[str]:
    return [w for w in (w.strip(_EDGE) for w in text.lower().split()) if w]


def _keys(word: str) -> set[str]:
    """The word and, marked, its beginnings."""
    return {word} | {f"{word[:n]}*" for n in STEMS if len(word) > n}


def _hits(words: frozenset, stems: frozenset):
    """Whether a word is in the lexicon (bit 0) or begins with a stem (bit 1); remembers what it has seen."""
    known: dict[str, int] = {}

    def look(word: str) -> int:
        found = known.get(word)
        if found is None:
            if len(known) > _REMEMBERED:
                known.clear()
            begins = any(f"{word[:n]}*" in stems for n in STEMS if len(word) > n)
            found = known[word] = (word in words) + 2 * begins
        return found

    return look


def _measured(text: str, look) -> list[float]:
    words = _plain(text)
    n = max(1, len(words))
    found = np.fromiter(map(look, words), np.uint8, len(words))
    lexicon, stem = np.flatnonzero(found & 1), np.flatnonzero(found & 2)
    second = np.flatnonzero(np.fromiter((w in SECOND_PERSON for w in words), bool, len(words)))
    proximity = 0.0
    either = np.flatnonzero(found)
    if len(either) and len(second):
        after = np.searchsorted(second, either)
        gaps = np.minimum(
            np.abs(either - second[np.minimum(after, len(second) - 1)]), np.abs(either - second[np.maximum(after - 1, 0)])
        )
        proximity = float((1 / (1 + gaps)).max())
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    size = max(1, len(raw))
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    lower = int(((raw >= 97) & (raw <= 122)).sum())
    marks = int(((raw >= 33) & (raw <= 47)).sum())
    return [
        np.log1p(len(words)), len(lexicon) / n, len(lexicon), len({words[k] for k in lexicon}), len(stem) / n, len(stem),
        len({words[k][: STEMS[0]] for k in stem}), len(second) / n, proximity, upper / max(1, upper + lower),
        float(upper > 4 * lower), text.count("!") / size, text.count("?") / size, marks / size,
        len(_OBFUSCATED.findall(text)) / n,
    ]


def measured(rows: DataFrame, words: frozenset, stems: frozenset) -> DataFrame:
    """``rows`` with the features in place of ``text``."""
    kept = [f for f in rows.schema if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _hits(words, stems)
        for batch in batches:
            values = np.array([_measured(t.as_py(), look) for t in batch["text"]], float).reshape(-1, len(FEATURES))
            columns = {f.name: batch[f.name] for f in kept}
            yield pa.RecordBatch.from_pydict(columns | {f: values[:, k] for k, f in enumerate(FEATURES)})

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{f} double" for f in FEATURES]
    return rows.mapInArrow(run, ", ".join(schema))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other texts of the task that hold each word or stem."""
    counts: dict[str, list[int]] = {}

    def out():
        columns = {"entry": pa.array(list(counts), pa.string())}
        for k, name in enumerate(("o", "t")):
            columns[name] = pa.array([c[k] for c in counts.values()], pa.int64())
        counts.clear()
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"].to_pylist()):
            for key in set().union(*map(_keys, set(_plain(text.as_py())))):
                counts.setdefault(key, [0, 0])[toxic] += 1
            if len(counts) > _HELD:
                yield out()
    yield out()


def learned_lexicon(rows: DataFrame, words: int = WORDS, stems: int = STEM_ENTRIES) -> tuple[frozenset, frozenset]:
    """Words and stems that lean to toxic texts, from ``rows`` (text, toxic: 0 or 1), counted over all of them.

    At most ``words`` and ``stems``, those in most toxic texts, as the model goes to every task.
    """
    totals = rows.agg(F.sum("toxic"), F.count("*")).first()
    toxic, other = totals[0] or 0, (totals[1] or 0) - (totals[0] or 0)
    if not toxic:
        return frozenset(), frozenset()
    counts = rows.mapInArrow(_entries, "entry string, o bigint, t bigint").groupBy("entry").agg(
        F.sum("t").alias("t"), F.sum("o").alias("o")
    )
    leans = F.col("t") / toxic > LEANING * (F.col("o") + 0.5) / max(1, other)
    leaning = stored(counts.where(leans & (F.col("t") >= min(WORD_SUPPORT, STEM_SUPPORT))), "leaning-entries")

    def most(stem: bool, support: int, bound: int) -> frozenset:
        some = leaning.where((F.col("entry").endswith("*") == stem) & (F.col("t") >= support))
        return frozenset(r["entry"] for r in some.orderBy(F.desc("t"), "entry").limit(bound).collect())

    return most(False, WORD_SUPPORT, words), most(True, STEM_SUPPORT, stems)


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``docs`` (doc_id, text) whose ids are in ``labels`` (doc_id, toxic).

    The sample is the labelled rows whose hash of the id falls into a share that
    makes about ``sample`` of them; it is chosen before any text is read, and its
    ids, of so bounded a number, go to every task, so that no text is moved for
    the choice. A third of its texts, by their hash, fits the trees and the
    calibration, half each; the lexicon is counted over all others. So none is
    judged on what the one before has seen. Texts that repeat count once. Null
    labels are left out, other labels than 0 count as 1.
    """
    marked = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic").cast("int") != 0).cast("int")).alias("toxic"))
    )
    labelled = stored(docs.select("doc_id").distinct().join(marked, "doc_id"), "toxicity-labels")
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, labelled.count()))) < sample
    ids = stored(labelled.where(drawn), "toxicity-sample-ids")
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(ids), "doc_id").select("text", "toxic")
    known = stored(rows.withColumn("h", F.xxhash64("text")).dropDuplicates(["h", "toxic"]), "toxicity-sample")
    kept = F.pmod("h", F.lit(3)) == 0
    words, stems = learned_lexicon(known.where(~kept).select("text", "toxic"))
    part = (F.pmod(F.xxhash64("h"), F.lit(2)) + 1).alias("part")
    features = stored(measured(known.where(kept).select("text", "toxic", part), words, stems), "toxicity-features")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features)
    fit, check = rows.where("part = 1"), rows.where("part = 2")
    found = {r["part"]: (r["n"], r["t"]) for r in features.groupBy("part").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).collect()}
    n, t = (sum(v[k] for v in found.values()) for k in (0, 1))
    rate = t / n if n else 0.0
    if not all(0 < found.get(k, (0, 0))[1] < found[k][0] for k in (1, 2) if k in found) or len(found) < 2:
        return Model(words, stems, None, None, rate)
    trees = GBTClassifier(labelCol="toxic", maxIter=20, maxDepth=4, stepSize=0.2, seed=1).fit(fit)
    scored = trees.transform(check).select(
        vector_to_array("probability")[1].alias("raw"), F.col("toxic").cast("double").alias("label")
    )
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(scored)
    return Model(words, stems, trees, calibration, rate)


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` without ``text``, with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    A null text counts as empty and is scored like any other. Without a model
    (no labels, or only one kind) every score is the rate of toxic labels.
    """
    plain = rows.withColumn("text", text_or_empty())
    names = [c for c in plain.columns if c != "text"]
    features = measured(plain, model.words, model.stems)
    if model.trees is None:
        done = features.withColumn("score", F.lit(float(model.rate)))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features)
        raw = model.trees.transform(vectors).withColumn("raw", vector_to_array("probability")[1])
        calibrated = model.calibration.setPredictionCol("calibrated").transform(raw)
        done = calibrated.withColumn("score", F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)))
    return done.select(*names, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
