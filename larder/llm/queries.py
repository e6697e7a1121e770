"""The operators of this package over whole tables, under production parameters."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.llm import (
    block_names, decontaminate, language, licences, mixing, simhash, site_lines, spelling, suffixes, tokens, toxicity,
    voronoi, whitening,
)
from larder.llm.common import stored, table


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public vocabulary lies; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _remainder(of: int):
    """crc32 of the id as text, modulo ``of``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % of


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", _remainder(4) == 2)
    model = language.trained(docs.where("NOT held_out").select("text", "lang"))
    return language.identified(docs.select("doc_id", "held_out", "text"), model)


def op2_wavelet_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.round_trip(table(spark, folder, "documents"), tokenizer_file())


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        F.expr("if(no_id, null, id)").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scanned(table(spark, folder, "documents"))


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = mixing.measured(table(spark, folder, "documents").select("doc_id", "source", "text")).drop("text")
    mixed = mixing.mixed(stored(docs, "mix-sizes"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("mix_size")).cast("bigint").alias("taken"),
    )


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return block_names.exact_duplicates(table(spark, folder, "documents"))


def op8_site_lines(spark: SparkSession, folder: str) -> DataFrame:
    return site_lines.without_boilerplate(table(spark, folder, "pages"))


def op9_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffixes.without_repeats(table(spark, folder, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text").withColumn("held_out", _remainder(5) == 0)
    model = toxicity.trained(docs.where("NOT held_out"), table(spark, folder, "labels"))
    return toxicity.scored(docs, model)


def _misspelled(doc_id: str):
    """Takes one code point from about one in 31 of a document's words, chosen by the id and the word."""
    start = zlib.crc32(f"{doc_id}:".encode())

    def edit(word: str) -> str:
        h = zlib.crc32(word.encode(), start)
        at = h % len(word)
        return word if h % 31 else word[:at] + word[at + 1 :]

    return edit


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"), _misspelled)


def op12_voronoi_join(spark: SparkSession, folder: str) -> DataFrame:
    return voronoi.embedding_neighbours(table(spark, folder, "embeddings"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.embedding_whitening(table(spark, folder, "embeddings"))


QUERIES = {
    "op1_language": op1_language,
    "op2_wavelet_tokens": op2_wavelet_tokens,
    "op3_simhash": op3_simhash,
    "op4_decontaminate": op4_decontaminate,
    "op5_licences": op5_licences,
    "op6_mix_sources": op6_mix_sources,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_site_lines": op8_site_lines,
    "op9_suffix_array": op9_suffix_array,
    "op10_toxicity": op10_toxicity,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_voronoi_join": op12_voronoi_join,
    "op13_whitening": op13_whitening,
}
