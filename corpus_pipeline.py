"""The corpus pipeline: language, repeated lines, near copies, benchmark passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.catalog.base import table
from larderline.llm import decontaminate, language, line_dedup, near_words, packing
from larderline.llm.catalog import tokenizer_file
from larderline.llm.common import fresh
from larderline.session import fresh_path


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told: those without a letter, and those in which no language stands out, go."""
    lang, score, unsure = names = tuple(fresh(docs, n) for n in ("lang_pred", "score", "ambiguous"))
    told = language.identify(docs, language.train_model(docs), names=names)
    return told.where((F.col(lang) != language.NONE) & ~F.col(unsure)).select(*docs.columns)


def without_spread_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many sites stay where they stand first; documents of which no word is left go. n_chars follows the text."""
    _, removed = names = tuple(fresh(docs, n) for n in ("n_lines", "n_removed"))
    clean = line_dedup.remove_spread_lines(docs, names=names).where((F.col(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, a similarity of 0.8 or more), one document."""
    return near_words.drop_near_copies(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with a checksum of their ids."""
    return packing.digest(docs, tokenizer_file())


STAGES = [("language", by_language), ("line_dedup", without_spread_lines), ("simhash", one_of_near_copies), ("decontaminate", without_benchmarks), ("packing", packed)]

#: No SQL states classifiers, fingerprints of words or tilings; tests compare the stages with plain loops.
ORACLE_SQL = None


def stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return spark.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each stage's table is written to the shared folder and read by the next; earlier
    ones are removed as soon as they have been read, the input of the last one stays for the caller."""
    folder = fresh_path(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
