"""Registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larderline.catalog.base import Registry, table
from larderline.llm import alignment, byte_bpe, decontaminate, language, line_dedup, lm_score, packing, pii, repetition, simhash, toxicity, url_filter, whitening

REGISTRY = Registry()


def tokenizer_file() -> str:
    """The word-wise public vocabulary of the packing query."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@REGISTRY.add("op1_packing")
def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.digest(table(spark, sf, "documents"), tokenizer_file())


@REGISTRY.add("op2_pii")
def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.query(table(spark, sf, "documents"))


@REGISTRY.add("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.query(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@REGISTRY.add("op4_line_dedup", line_dedup.sql())
def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.remove_spread_lines(table(spark, sf, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@REGISTRY.add("op5_url_filter", url_filter.sql())
def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.query(table(spark, sf, "pages"))


@REGISTRY.add("op6_simhash")
def op6_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.query(table(spark, sf, "documents"))


@REGISTRY.add("op7_repetition")
def op7_repetition(spark: SparkSession, sf: str) -> DataFrame:
    return repetition.query(table(spark, sf, "documents"))


@REGISTRY.add("op8_lm_score")
def op8_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    return lm_score.query(table(spark, sf, "documents"))


@REGISTRY.add("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.query(table(spark, sf, "documents"), table(spark, sf, "labels"))


@REGISTRY.add("op10_language")
def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.predict(table(spark, sf, "documents"))


def byte_rules() -> byte_bpe.BpeRules:
    """The ranks and the pattern of the byte-level public vocabulary."""
    import public_tokenizers
    return byte_bpe.BpeRules(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@REGISTRY.add("op11_byte_bpe")
def op11_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return byte_bpe.query(table(spark, sf, "documents"), byte_rules())


@REGISTRY.add("op13_whitening")
def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.query(table(spark, sf, "embeddings"))


def align_rules() -> alignment.AlignRules:
    """The public byte-level and piece vocabularies."""
    import public_tokenizers
    return alignment.AlignRules(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@REGISTRY.add("op12_alignment")
def op12_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.query(table(spark, sf, "documents"), align_rules())
