"""Benchmark decontamination by greedy string tiling: long common token runs, longest first, without overlap."""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import fresh, slices
from larderline.session import cut

TOKEN = regex.compile(r"[\p{L}\p{N}]+")
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


@dataclass(frozen=True)
class TilingRules:
    min_match: int = 5         # shortest tile, in tokens; also the length of the seeds
    first_length: int = 20     # length of the first search; it grows to twice a longer find and then halves
    coverage: float = 0.5      # share of an item's tokens inside tiles from which a document is contaminated
    bitmap_bits: int = 23      # 2**bits seed flags go to the tasks: a fixed size, whatever the number of items


def token_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the runs of letters and digits of a text, without case."""
    if not text:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(t) for t in TOKEN.findall(text.lower())), np.uint64)


def rolling(tokens: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``length`` tokens, by doubling: a window is two overlapping-free parts."""
    n = len(tokens) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        done, out, size, power, block = 0, np.zeros(n, np.uint64), 1, BASE, tokens.copy()
        while True:
            if length & size:
                # the windows so far are followed by a block of this size
                out = out * power + block[done:done + n]
                done += size
            if done == length:
                return out
            block = block[:-size] * power + block[size:]
            size, power = size * 2, power * power


def open_windows(tokens: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of ``size`` free tokens begin, and their hashes."""
    if len(tokens) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    count = np.concatenate(([0], np.cumsum(free)))
    where = np.flatnonzero(count[size:] - count[:-size] == size)
    return where, rolling(tokens, size)[where]


def beside(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which values of ``a`` are in ``b``; both rise."""
    at = np.searchsorted(b, a)
    return (at < len(b)) & (b[np.minimum(at, len(b) - 1)] == a) if len(b) else np.zeros(len(a), bool)


def matches(d: np.ndarray, free_d: np.ndarray, t: np.ndarray, free_t: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(-length, place in t, place in d) of the common runs of ``size`` free tokens or more that can't be made longer.

    Windows are looked up by their rolling hashes; windows that follow each other in both texts are one run. The work
    for a window of the item is linear in the windows of the document that equal it, and only runs are kept.
    """
    in_d, hash_d = open_windows(d, free_d, size)
    in_t, hash_t = open_windows(t, free_t, size)
    order = np.argsort(hash_d, kind="stable")
    in_d, hash_d = in_d[order], hash_d[order]
    low, high = np.searchsorted(hash_d, hash_t, "left"), np.searchsorted(hash_d, hash_t, "right")
    heads, tails, last, before = [], [], -2, in_d[:0]
    for j, a, b in [*zip(in_t.tolist(), low.tolist(), high.tolist()), (len(t) + 1, 0, 0)]:
        here = in_d[a:b]
        follows = j == last + 1
        heads.append((here[~beside(here - 1, before)] if follows else here, j))
        tails.append((before[~beside(before + 1, here)] if follows else before, last))
        last, before = j, here

    def sorted_runs(parts: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
        i = np.concatenate([x for x, _ in parts])
        j = np.repeat([k for _, k in parts], [len(x) for x, _ in parts])
        run = np.lexsort((i, i - j))
        return i[run], j[run]

    (i, j), (end, _) = sorted_runs(heads), sorted_runs(tails)
    return list(zip((i - end - size).tolist(), j.tolist(), i.tolist()))


def tiles(doc: np.ndarray, item: np.ndarray, rules: TilingRules) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in doc, start in item, length) of the tiles.

    Searches with falling length: windows of the item that no tile covers are looked up among those of the document by
    their rolling hash, and of the runs they make, the longest are marked first; what a longer tile leaves free of a run
    is a run again. A find beyond twice the search length restarts the search at its length. Ties go to the first in the
    item, then the first in the document. Texts of one token over and over give a run for each place, not for each window.
    """
    low = min(rules.min_match, len(item))
    if low < rules.min_match or len(doc) < low:
        return []
    near = np.flatnonzero(np.isin(rolling(doc, low), rolling(item, low)))
    if not len(near):
        return []
    used = np.zeros(len(doc), bool)            # only tokens in a common window of the least length can be in a tile
    for k in range(low):
        used[near + k] = True
    where = np.flatnonzero(used)
    # runs of those tokens, kept apart by one taken position each
    gap = np.flatnonzero(np.diff(where) > 1)
    at = np.insert(where, gap + 1, -1)
    d, free_d, free_t = np.where(at >= 0, doc[np.maximum(at, 0)], np.uint64(0)), at >= 0, np.ones(len(item), bool)
    found: list[tuple[int, int, int]] = []
    length = max(low, min(rules.first_length, len(item)))
    while True:
        runs = matches(d, free_d, item, free_t, length)
        longest = -min(runs, default=(0,))[0]
        if longest > 2 * length:
            length = longest
            continue
        heapify(runs)
        while runs and free_t.any():
            size, j, i = heappop(runs)
            free = free_d[i:i - size] & free_t[j:j - size]
            if free.all():
                if np.array_equal(d[i:i - size], item[j:j - size]):  # hashes alone don't decide
                    found.append((int(at[i]), j, -size))
                    free_d[i:i - size] = free_t[j:j - size] = False
                continue
            edge = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8)))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if b - a >= length:
                    heappush(runs, (a - b, j + a, i + a))
        if length == low or not free_t.any():
            return found
        length = max(low, length // 2) if length > 2 * low else low


def bitmap_of(items: DataFrame, rules: TilingRules) -> bytes:
    """Flags of the seeds of all items, folded to a fixed number of bits; tasks flag their own items, and flags are merged by 'or'."""
    bits, least = rules.bitmap_bits, rules.min_match

    def flag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            slots = [rolling(token_hashes(t), least) >> np.uint64(64 - bits) for t in pdf["text"]]
            yield pd.DataFrame({"word": np.unique(np.concatenate(slots or [np.zeros(0, np.uint64)])).astype(np.int64)})

    rows = (items.mapInPandas(flag, "word long").select(F.shiftright("word", 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("word").bitwiseAND(F.lit(63)).cast("int")).alias("flag"))
            .groupBy("at").agg(F.bit_or("flag").alias("flag")).toPandas())  # at most 2**bits / 64 rows
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["flag"].to_numpy(np.int64)
    return out.view(np.uint8).tobytes()


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
               item_text: str = "text", rules: TilingRules = TilingRules()) -> DataFrame:
    """Contaminated pairs: doc, item, coverage (share of the item's tokens in tiles), n_tiles, longest, first_at (token
    of the document where its first tile starts).

    1. A scan of the documents keeps those with a window of ``min_match`` tokens whose flag is set, with the windows'
       hashes and the hashes of their tokens. The flags are of fixed size and only spare rows.
    2. The windows join the items' windows; distinct positions of an item that a document reaches bound its coverage,
       and pairs that can't get there go.
    3. Each item meets the tokens of the document, and greedy string tiling gives the coverage.

    Tokens are runs of letters and digits, without case. Items with fewer tokens than ``min_match`` have no tile and
    are never found. Null or empty texts have no tokens. Equal ids with different texts are tiled apart, and the
    best coverage counts; repeated rows give one pair; null ids are kept as such. Other columns aren't read. Whole
    texts are read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    slim = items.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("text"))
    flags = spark.sparkContext.broadcast(bitmap_of(slim, rules))
    least, bits = rules.min_match, rules.bitmap_bits

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flag = np.frombuffer(flags.value, np.uint8)
        for batch in slices(batches):
            rows, seeds, tokens, starts = [], [], [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                h = token_hashes(t)
                windows = rolling(h, least)
                slot = (windows >> np.uint64(64 - bits)).astype(np.int64)
                hit = windows[(flag[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)]
                if len(hit):
                    rows.append(i)
                    seeds.append(np.unique(hit).view(np.int64))
                    tokens.append(h.tobytes())
            yield pa.RecordBatch.from_pydict({"doc": batch.column("doc").take(pa.array(rows, pa.int64())), "seeds": pa.array(seeds, pa.list_(pa.int64())), "tokens": pa.array(tokens, pa.binary())})

    def item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, seeds, tokens, count = [], [], [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                h = token_hashes(t)
                if len(h) >= least:
                    rows.append(i)
                    seeds.append(rolling(h, least).view(np.int64))
                    tokens.append(h.tobytes())
                    count.append(len(h))
            yield pa.RecordBatch.from_pydict({"item": batch.column("item").take(pa.array(rows, pa.int64())), "seeds": pa.array(seeds, pa.list_(pa.int64())), "item_tokens": pa.array(tokens, pa.binary()), "m": pa.array(count, pa.int64())})

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            out = {"doc": [], "item": [], "coverage": [], "n_tiles": [], "longest": [], "first_at": []}
            for row in batch.to_pylist():
                d, t = np.frombuffer(row["tokens"], np.uint64), np.frombuffer(row["item_tokens"], np.uint64)
                found = tiles(d, t, rules)
                share = sum(x[2] for x in found) / len(t)
                if share >= rules.coverage:
                    for k, v in zip(out, (row["doc"], row["item"], share, len(found), max(x[2] for x in found), min(x[0] for x in found))):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, kind) for (k, v), kind in zip(out.items(), (doc_kind, item_kind, pa.float64(), pa.int64(), pa.int64(), pa.int64()))})

    from pyspark.sql.pandas.types import to_arrow_type
    doc_type, item_type = docs.schema[doc_id].dataType, items.schema[item_id].dataType
    doc_kind, item_kind = to_arrow_type(doc_type), to_arrow_type(item_type)
    d, t = doc_type.simpleString(), item_type.simpleString()
    hit = cut(docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text")).mapInArrow(scan, f"doc {d}, seeds array<bigint>, tokens binary")
              .withColumn("row", F.xxhash64("doc", "tokens")))
    wanted = slim.mapInArrow(item_windows, f"item {t}, seeds array<bigint>, item_tokens binary, m long").distinct()
    wanted = wanted.withColumn("of", F.xxhash64("item", "item_tokens"))
    places = wanted.select("of", "m", F.posexplode("seeds").alias("pos", "seed"))
    pairs = (hit.select("row", F.explode("seeds").alias("seed")).distinct().join(places, "seed")
             .groupBy("row", "of", "m").agg(F.countDistinct("pos").alias("n")))
    # n windows reach at most n * min_match tokens
    pairs = pairs.where(F.col("n") * least >= F.col("m") * rules.coverage)
    # a row a pair, so that a document with many items is many rows
    met = pairs.select("row", "of").join(wanted.select("of", "item", "item_tokens"), "of")
    tiled = hit.select("row", "doc", "tokens").dropDuplicates(["row"]).join(met, "row").select("doc", "tokens", "item", "item_tokens").mapInArrow(
        tile, f"doc {d}, item {t}, coverage double, n_tiles long, longest long, first_at long")
    best = tiled.groupBy("doc", "item").agg(F.max(F.struct("coverage", "longest", "n_tiles", "first_at")).alias("x"))
    return best.select("doc", "item", "x.coverage", "x.n_tiles", "x.longest", "x.first_at")


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: TilingRules = TilingRules()) -> DataFrame:
    """``docs`` without those that hold an item; rows with such an id all go."""
    name = fresh(docs, "_bad")
    bad = find_leaks(docs, items, doc_id, text, rules=rules).select(F.col("doc").alias(name)).distinct()
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col(name)), "left_anti")


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return find_leaks(docs, items).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "coverage", "n_tiles", "longest", "first_at")
