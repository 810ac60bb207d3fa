"""Near copies by SimHash: segment popcounts of the fingerprints, a grid join under Manhattan distance, exact check.

A fingerprint is cut into segments of two bits, and each becomes its number of set bits (0, 1, 2). The Manhattan
distance of two such vectors is never above the Hamming distance of the fingerprints. If it is at most 3 over the whole
vector, it is at most 1 in one of its two halves; so every link is found in a grid cell that is a half vector, if each
fingerprint also visits the cells at distance 1. Vectors are kept in unary code (00, 01, 11), where distance is the
number of differing bits.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import components, fresh, lower, raw, slices, words
from larderline.session import cut

BITS = 3      # links differ in so many bits or fewer; halves and visits of the grid follow from it
SEED = 42
LOW = 0x5555555555555555
FEW = 32      # the fingerprints that live in a cell up to this size are compared with all in it at once
SMALL = 2048  # a larger cell up to this size is walked through as it is, beyond that by blocks of 16 bits


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = SEED) -> int:
    """SimHash of a text's word shingles (signed 64 bits): bit set if set in over half of their XXH64; no words: 0."""
    w = words(lower(text))
    if not w:
        return 0
    line = b" ".join(w)
    if len(w) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    else:
        end = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
        begin = np.concatenate(([0], end[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(begin[:len(w) - shingle + 1].tolist(), end[shingle - 1:].tolist())), np.uint64, len(w) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    set_bits = 2 * ones > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """(doc, fp) and the long columns ``more`` of every row; a null or empty text has fingerprint 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("doc", *more)} | {"fp": pa.array([fingerprint(t) for t in raw(batch, "text")], pa.int64())})

    slim = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"), *more)
    return slim.mapInArrow(run, "".join(f"{c} long, " for c in ("doc", *more)) + "fp long")


def unary(fp: Column) -> Column:
    """Popcounts of the 32 two-bit segments of a fingerprint, each in unary code."""
    low, high = fp.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def cells(unique: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """(cell, fp, ``more``, home): the two cells where a fingerprint lives, and the cells at distance 1 that it visits."""
    halves = F.array(F.col("u").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("u", 32))
    homes = unique.select("fp", *more, unary(F.col("fp")).alias("u")).select("fp", *more, F.posexplode(halves).alias("half", "v"))

    def valid(k: Column) -> Column:  # the lower bit may turn while the upper is 0, the upper while the lower is 1
        return F.when(k % 2 == 0, F.getbit("v", F.least(k + 1, F.lit(31))) == 0).otherwise(F.getbit("v", F.greatest(k - 1, F.lit(0))) == 1)

    turned = F.transform(F.filter(F.sequence(F.lit(0), F.lit(31)), valid), lambda k: F.col("v").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    where = F.concat(F.array(F.struct(F.col("v").alias("cell"), F.lit(True).alias("home"))), F.transform(turned, lambda v: F.struct(v.alias("cell"), F.lit(False).alias("home"))))
    return homes.select("fp", *more, "half", F.inline(where)).select((F.col("cell") * 2 + F.col("half")).alias("cell"), "fp", *more, "home")


def near_u64(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs are links: first by the Manhattan distance of the popcounts, then by the fingerprints."""
    ua, ub = unary_u64(a), unary_u64(b)
    close = np.bitwise_count(ua ^ ub) <= BITS
    close[close] = np.bitwise_count((a ^ b)[close]) <= BITS
    return close


def unary_u64(x: np.ndarray) -> np.ndarray:
    low, high = x & np.uint64(LOW), (x >> np.uint64(1)) & np.uint64(LOW)
    return low | high | ((low & high) << np.uint64(1))


def tree(fps: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold the linked fingerprints of one group together: a walk that reaches each one once."""
    a, b, open_ = [], [], np.ones(len(fps), bool)
    u = unary_u64(fps)
    for seed in np.flatnonzero(home):
        if not open_[seed]:
            continue
        open_[seed] = False
        stack = [seed]
        while stack:
            at = stack.pop()
            rest = np.flatnonzero(open_)
            if not len(rest):
                break
            rest = rest[np.bitwise_count(u[rest] ^ u[at]) <= BITS]
            rest = rest[np.bitwise_count(fps[rest] ^ fps[at]) <= BITS]
            open_[rest] = False
            a += [fps[at]] * len(rest)
            b += fps[rest].tolist()
            stack += rest.tolist()
    return np.array(a, np.uint64), np.array(b, np.uint64)


def links_in(fps: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one cell. In a long one, links agree in one of four blocks of 16 bits, which split it further."""
    if len(fps) <= SMALL:
        return tree(fps, home)
    out = []
    for k in range(4):
        block = (fps >> np.uint64(16 * k)) & np.uint64(0xFFFF)
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[order])) + 1
        for part in np.split(order, cuts):
            if len(part) > 1:
                out.append(tree(fps[part], np.ones(len(part), bool)))
    return np.concatenate([x for x, _ in out] or [fps[:0]]), np.concatenate([y for _, y in out] or [fps[:0]])


def links(unique: DataFrame) -> DataFrame:
    """(a, b): links between different fingerprints, enough of them to hold each component together.

    The rows of the grid are dealt and sorted by cell, and each task walks through its cells. A cell holds different
    fingerprints only, as copies have become one before; a dense cell gives a tree of links, not all its pairs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush(cell: np.ndarray, fp: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
            begin = np.concatenate(([0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]))
            size = np.diff(begin)
            lives = np.flatnonzero(home)
            of = np.repeat(np.arange(len(size)), size)[lives]
            lives = lives[(size[of] > 1) & (size[of] <= FEW)]
            of = np.repeat(np.arange(len(size)), size)[lives]
            left = np.repeat(lives, size[of])
            right = np.arange(len(left)) - np.repeat(np.cumsum(size[of]) - size[of], size[of]) + np.repeat(begin[of], size[of])
            close = (left != right) & near_u64(fp[left], fp[right])
            a, b = [fp[left[close]]], [fp[right[close]]]
            for k in np.flatnonzero((size > FEW) & (np.add.reduceat(home.astype(np.int64), begin[:-1]) > 0)):
                x, y = links_in(fp[begin[k]:begin[k + 1]], home[begin[k]:begin[k + 1]])
                a.append(x)
                b.append(y)
            return pa.RecordBatch.from_pydict({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

        for batch in batches:
            now = (batch.column("cell").to_numpy(), batch.column("fp").to_numpy().view(np.uint64), batch.column("home").to_numpy(zero_copy_only=False))
            if not len(now[0]):
                continue
            cell = now[0]
            change = np.flatnonzero(cell[1:] != cell[:-1]) + 1
            joined = bool(held) and held[-1][0][-1] == cell[0]
            if held and not joined:
                yield flush(*(np.concatenate(x) for x in zip(*held)))
                held = []
            if len(change):  # the last cell may go on in the next batch
                last = change[-1]
                held.append(tuple(x[:last] for x in now))
                yield flush(*(np.concatenate(x) for x in zip(*held)))
                held = [tuple(x[last:] for x in now)]
            else:
                held.append(now)
        if held:
            yield flush(*(np.concatenate(x) for x in zip(*held)))

    n = int(unique.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells(unique.repartition(n, "fp")).repartition(n, "cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """(doc, fp, component) and the long columns ``more`` of every row: component is the smallest id that can be reached over links.

    Rows with equal fingerprints (exact copies, repeated rows, all texts without a word) are one class and always
    linked. A null id stays in the result and is never the name of a component unless the whole class has null ids.
    Equal ids with different texts are separate rows. Other columns aren't read. An empty table gives an empty result.
    """
    prints = cut(fingerprints(docs, doc_id, text, more))
    unique = prints.groupBy("fp").agg(F.min("doc").alias("first"))
    root = components(links(unique.select("fp")))
    labelled = unique.join(root, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = labelled.groupBy("root").agg(F.min("first").alias("component"))
    classes = cut(labelled.join(named, "root").select(F.col("fp").alias("of"), "component"))
    return prints.join(classes, F.col("fp") == F.col("of")).select("doc", *more, "fp", "component")


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with its smallest id, then the smallest hash of the text.

    A row is told by two hashes of its id and text; of rows that repeat both, one stays. A null id comes after all others.
    """
    k1, k2 = fresh(docs, "_k1"), fresh(docs, "_k2")
    keys = [F.xxhash64(F.col(doc_id), F.col(text)).alias(k1), F.xxhash64(F.col(text), F.lit("second"), F.col(doc_id)).alias(k2)]
    slim = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"), *keys)
    rank = F.struct(F.col("doc").isNull().alias("last"), "doc", k1, k2)
    kept = (near_copies(slim, "doc", "text", (k1, k2)).groupBy("component", F.when(F.col("component").isNull(), F.col("fp")).alias("nameless"))
            .agg(F.min(rank).alias("best")).select(f"best.{k1}", f"best.{k2}"))
    return docs.select("*", *keys).join(kept, [k1, k2], "left_semi").dropDuplicates([k1, k2]).drop(k1, k2)


def query(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return near_copies(docs).select(F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
