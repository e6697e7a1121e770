"""A corpus from raw documents to token files: stages that each take and give whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import decontaminate, mixing, simhash, tokens, toxicity
from larder.llm.common import dropped, stored, table
from larder.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half; labels of the given documents train the model."""
    model = toxicity.trained(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    whole = docs.selectExpr("struct(*) AS row", "text")
    return toxicity.scored(whole, model).where("predicted = 0").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id, of each group whose fingerprints are linked: three words, two bits."""
    return simhash.deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target shares."""
    return mixing.drawn(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, and where each document lies in them."""
    return tokens.round_trip(docs, tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("near-copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

# training a classifier and tokenising are not SQL; tests/llm/test_pipeline.py has the brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each stage's rows are written and read again.

    A stage's rows are deleted once the next stage's are stored; the last stage reads its token files only.
    """
    rows, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        rows, used = stored(stage(spark, rows, sf_dir), f"pipeline-{name}"), before
        before = rows
        if used is not None:
            dropped(used)
    return STAGES[-1][1](spark, rows, sf_dir)
