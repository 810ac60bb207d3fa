"""Shared helpers: hash folds, batches of rows in Python tasks, connected components."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.session import cut


def fold(doc_id: str, of: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo ``of``. A null id falls in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % of, F.lit(0))


def raw(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def words(text: bytes | None) -> list[bytes]:
    """Words between ASCII blanks (``[^\\x20\\x09-\\x0D]+``); none for null."""
    return text.split() if text else []


def lower(text: bytes | None) -> bytes:
    """A-Z lower-cased, other characters untouched; empty for null."""
    return text.lower() if text else b""


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a step holds the results of few documents at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a sorted array, and its length at the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def with_fields(df: DataFrame, columns: list[str], made: str, text: str | None = None) -> T.StructType:
    """Schema of ``columns`` of ``df`` (the one named ``text`` as a string) and of what is made besides, as DDL."""
    kept = [T.StructField(f.name, T.StringType()) if f.name == text else f for f in df.select(*columns).schema.fields] if columns else []
    return T.StructType(kept + T.StructType.fromDDL(made).fields)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b: longs): rows (node, root) of
    all nodes but the roots, root the smallest node reachable.

    Star contraction: each round hangs every larger neighbour of a node on the smallest one, then every node on its
    smallest neighbour; the number of rounds grows with the logarithm of the longest chain. A round is two
    aggregations with partial sums and joins that Spark can split; nothing is gathered per node. Each round is written
    to the checkpoint folder. Only a count and a checksum reach the driver.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def checksum(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    before = None
    while (now := checksum(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), "m")
        small = (large.join(least, F.col("a") == F.col("of"))
                 .select(F.inline(F.array(F.struct(F.greatest("b", "m").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b"))))))
        edges = cut(small.where("a <> b").distinct())
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
