"""Language-model scores by deleted interpolation of word and word-pair estimates.

Documents are worked on in blocks. A block counts its different words and pairs, sends the counts, packed by range of
their hashes, to buckets, where all blocks' counts add up, and gets back the corpus counts of just its own words and
pairs. A key comes once from a block, however frequent it is, so that buckets stay even and no key is hot. The mixture
weights are learned from a part of the training documents whose own counts are taken off ("deleted").
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import fold, lower, raw, slices, words
from larderline.session import cut

END, START = b"\n", b"\r"       # no word has such bytes
WORD, PAIR, DOCS, TOTAL = 0, 1, 2, 3
HELD, DELETED, KEPT = 0, 1, 2   # parts of the documents
PAIR_BITS = 52                  # of a pair's hash; words have all 64
CELLS = 8                       # cells of the learning table for each doubling of a ratio


@dataclass(frozen=True)
class ScoreRules:
    folds: int = 10
    held_fold: int = 0         # fold of the documents that are scored without being learned from
    deleted_fold: int = 9      # training fold that the mixture weights are learned from
    block_tokens: int = 3_000_000
    base_add: float = 0.1      # additive constant of the base score
    rounds: int = 200          # of expectation-maximisation
    floor: float = 1e-4        # least weight of the uniform part


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes."""
    v = np.ascontiguousarray(values, np.uint64)
    return zstandard.ZstdCompressor(level=3).compress(np.uint64(len(v)).tobytes() + v.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    plain = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(plain[:8], np.uint64)[0])
    return np.ascontiguousarray(np.frombuffer(plain[8:], np.uint8).reshape(8, n).T).reshape(-1).view(np.uint64)


def packed_sorted(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def pair_keys(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    x = before * np.uint64(0x9E3779B97F4A7C15) + now
    for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(m)
    return (x ^ (x >> np.uint64(29))) >> np.uint64(64 - PAIR_BITS)


def bounds(buckets: int, bits: int) -> np.ndarray:
    """Where the hash ranges of the buckets begin."""
    return np.array([(k << bits) // buckets for k in range(buckets)], np.uint64)


class Block:
    """Documents on the way into one block."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.tokens: list[np.ndarray] = []
        self.docs: list = []
        self.held: list[bool] = []
        self.size = 0

    def add(self, doc, held: bool, text: bytes | None) -> None:
        w = words(lower(text))
        w.append(END)
        known = self.known
        self.tokens.append(np.fromiter((known.setdefault(x, len(known)) for x in w), np.int64, len(w)))
        self.docs.append(doc)
        self.held.append(held)
        self.size += len(w)

    def rows(self, number: int, deleted: bool, buckets: int) -> Iterator[dict]:
        self.known.setdefault(START, len(self.known))
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(x) for x in self.known), np.uint64, len(self.known))
        order = np.argsort(h)
        rank = np.empty(len(h), np.int64)
        rank[order] = np.arange(len(h))
        vocabulary, tokens = h[order], rank[np.concatenate(self.tokens)]
        length = np.array([len(t) for t in self.tokens])
        start = int(rank[self.known[START]])
        pairs = pair_keys(vocabulary[before(tokens, length, start)], vocabulary[tokens])
        learned = np.repeat(~np.array(self.held), length)
        of_word = np.bincount(tokens[learned], minlength=len(vocabulary))
        of_word[start] = int((~np.array(self.held)).sum())
        keys, where = np.unique(pairs, return_inverse=True)
        of_pair = np.bincount(where[learned], minlength=len(keys))
        for kind, values, count, bits in ((WORD, vocabulary, of_word, 64), (PAIR, keys, of_pair, PAIR_BITS)):
            edge = np.append(np.searchsorted(values, bounds(buckets, bits)), len(values))
            for k in range(buckets):
                a, b = edge[k], edge[k + 1]
                if a < b:
                    yield {"bucket": k, "kind": kind, "block": number, "deleted": deleted, "a": packed_sorted(values[a:b]), "b": packed(count[a:b])}
        seen = np.bincount(tokens, minlength=len(vocabulary))
        yield {"bucket": number % buckets, "kind": DOCS, "block": number, "deleted": deleted, "b": packed(np.argsort(by_frequency(seen))[tokens]),
               "c": packed(length), "d": packed(seen), "docs": self.docs, "held": self.held}


def by_frequency(seen: np.ndarray) -> np.ndarray:
    """Words in falling order of their count, so that the frequent ones get small numbers, which pack well."""
    return np.argsort(-seen.astype(np.int64), kind="stable")


def before(tokens: np.ndarray, length: np.ndarray, start: int) -> np.ndarray:
    """The token before each token; the start token before the first of a document."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[np.cumsum(length) - length] = start
    return out


SCHEMA = "bucket int, kind int, block long, deleted boolean, a binary, b binary, c binary, d binary, docs array<bigint>, held array<boolean>"
ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("deleted", pa.bool_()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary()),
                   ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))])


def blocks(docs: DataFrame, buckets: int, rules: ScoreRules) -> DataFrame:
    """Counts and texts of all blocks. ``docs``: doc, part, text. The deleted part has blocks of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        open_ = {True: Block(), False: Block()}

        def leave(deleted: bool) -> pa.RecordBatch:
            nonlocal number
            rows = list(open_[deleted].rows(number, deleted, buckets))
            open_[deleted] = Block()
            number += 1
            return pa.RecordBatch.from_pylist(rows, ARROW)

        for batch in slices(batches):
            for doc, part, text in zip(batch.column("doc").to_pylist(), batch.column("part").to_pylist(), raw(batch, "text")):
                block = open_[part == DELETED]
                block.add(doc, part == HELD, text)
                if block.size >= rules.block_tokens:
                    yield leave(part == DELETED)
        for deleted in (True, False):
            if open_[deleted].size:
                yield leave(deleted)

    return docs.mapInArrow(run, SCHEMA)


def corpus_counts(sent: DataFrame) -> DataFrame:
    """For each block, the corpus counts of its words and pairs; its texts as they came; and each bucket's totals.

    Words come with their hashes, pairs just in order. A deleted block gets the counts without the deleted part in ``c`` besides.
    """
    start = np.uint64(xxhash.xxh64_intdigest(START))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out, bucket = [pdf[pdf["kind"] == DOCS]], int(pdf["bucket"].iloc[0])
        for kind in (WORD, PAIR):
            rows = pdf[pdf["kind"] == kind]
            if not len(rows):
                continue
            keys, counts = [unpacked_sorted(x) for x in rows["a"]], [unpacked(x) for x in rows["b"]]
            size = [len(k) for k in keys]
            found, where = np.unique(np.concatenate(keys), return_inverse=True)
            counts, off = np.concatenate(counts).astype(np.float64), np.repeat(rows["deleted"].to_numpy(bool), size)
            total = np.bincount(where, weights=counts, minlength=len(found)).astype(np.uint64)
            rest = total - np.bincount(where[off], weights=counts[off], minlength=len(found)).astype(np.uint64)
            parts = np.split(where, np.cumsum(size)[:-1])
            out.append(rows.assign(a=rows["a"] if kind == WORD else None, b=[packed(total[p]) for p in parts], c=[packed(rest[p]) if d else None for p, d in zip(parts, rows["deleted"])]))
            if kind == WORD:
                word = found != start
                sums = [int(x) for x in (total[word].sum(), (total[word] > 0).sum(), rest[word].sum(), (rest[word] > 0).sum())]
                out.append(pd.DataFrame({"bucket": [bucket], "kind": [TOTAL], "block": [-1], "deleted": [False], "a": [None], "b": [None], "c": [None], "d": [None], "docs": [sums], "held": [None]}))
        return pd.concat(out, ignore_index=True)[list(pdf.columns)]

    return sent.groupBy("bucket").applyInPandas(run, SCHEMA)


@dataclass
class Estimates:
    """A block's tokens with their corpus counts: of the word, of the one before, of the pair."""
    docs: list
    held: list
    length: np.ndarray
    word: np.ndarray
    context: np.ndarray
    pair: np.ndarray

    @classmethod
    def of(cls, pdf: pd.DataFrame, column: str) -> "Estimates":
        texts = pdf[pdf["kind"] == DOCS].iloc[0]
        rows = pdf.sort_values("bucket")
        count = [np.concatenate([unpacked(x) for x in rows.loc[rows["kind"] == k, column]]).astype(np.float64) for k in (WORD, PAIR)]
        vocabulary = np.concatenate([unpacked_sorted(x) for x in rows.loc[rows["kind"] == WORD, "a"]])  # the buckets' ranges follow each other
        length = unpacked(texts["c"]).astype(np.int64)
        tokens = by_frequency(unpacked(texts["d"]))[unpacked(texts["b"]).astype(np.int64)]
        start = int(np.searchsorted(vocabulary, np.uint64(xxhash.xxh64_intdigest(START))))
        last = before(tokens, length, start)
        where = np.unique(pair_keys(vocabulary[last], vocabulary[tokens]), return_inverse=True)[1]
        return cls(list(texts["docs"]), list(texts["held"]), length, count[0][tokens], count[0][last], count[1][where])

    def parts(self, total: float, different: float) -> tuple[np.ndarray, ...]:
        """Bucket of the context's frequency, and the estimates by pair, by word and by chance."""
        level = np.where(self.context > 0, np.floor(np.log2(np.maximum(self.context, 1))) + 1, 0).astype(np.int64)
        return level, self.pair / np.maximum(self.context, 1), self.word / max(total, 1), 1 / (different + 1)


def learning_table(counted: DataFrame, total: float, different: float) -> pd.DataFrame:
    """How often the deleted part's tokens have which ratios of the estimates: (level, pair, word, n), a row a cell.

    Ratios to the estimate by chance are told by cells of a fixed width in their logarithm (-1: none), so that the
    table is of bounded size.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        level, pair, word, chance = Estimates.of(pdf, "c").parts(total, different)
        cell = lambda p: np.where(p > 0, np.clip(np.round(np.log2(np.maximum(p / chance, 2.0 ** -20)) * CELLS) + 20 * CELLS, 0, 1 << 12), -1).astype(np.int64)
        key, n = np.unique((level << 32) + (cell(pair) + 1 << 16) + cell(word) + 1, return_counts=True)
        return pd.DataFrame({"key": key, "n": n})

    return counted.where(f"deleted and kind <> {TOTAL}").groupBy("block").applyInPandas(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()


def mixture(table: pd.DataFrame, rules: ScoreRules) -> np.ndarray:
    """Weights (pair, word, chance) of each level of context frequency, by expectation-maximisation.

    A level without a token in the deleted part has the weights of all levels together.
    """
    key, n = table["key"].to_numpy(np.int64), table["n"].to_numpy(float)
    back = lambda c: np.where(c > 0, 2.0 ** ((c - 1 - 20 * CELLS) / CELLS), 0.0)
    level, p = key >> 32, np.stack([back((key >> 16) & 0xFFFF), back(key & 0xFFFF), np.ones(len(key))], 1)

    def fit(mine: np.ndarray) -> np.ndarray:
        weight = np.full(3, 1 / 3)
        for _ in range(rules.rounds if mine.any() else 0):
            share = p[mine] * weight
            share /= share.sum(1, keepdims=True)
            weight = (share * n[mine, None]).sum(0) / n[mine].sum()
        weight[2] = max(weight[2], rules.floor)
        return weight / weight.sum()

    every = fit(np.ones(len(key), bool))
    return np.stack([fit(level == k) if (level == k).any() else every * (1, 1, 1) for k in range(65)])


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: Column | None = None, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """doc, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Tokens are the words between ASCII blanks, A-Z lower-cased, and one end. score is the log10 probability of the text
    under the mixture of pair, word and chance (1 / (V + 1)), its weights by the frequency of the word before;
    base_score that of single words with an additive constant. Only documents that aren't held out are learned from.

    A null or empty text is the end alone. A null id is held out. Rows that repeat are documents of their own. Whole
    texts are read; other columns aren't. Nothing to learn from: all words are unknown. An empty table gives an empty
    result. ``docs`` should be a stored table, as a task that repeats has to see its rows in the same order.
    """
    spark = docs.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    of = F.when(part == rules.held_fold, HELD).when(part == rules.deleted_fold, DELETED).otherwise(KEPT) if part is not None else (
        F.when(fold(doc_id, rules.folds) == rules.held_fold, HELD).when(fold(doc_id, rules.folds) == rules.deleted_fold, DELETED).otherwise(KEPT))
    slim = docs.select(F.col(doc_id).cast("long").alias("doc"), of.alias("part"), F.col(text).cast("string").alias("text"))
    counted = cut(corpus_counts(blocks(slim, spread, rules)))
    sums = [int(x or 0) for x in counted.where(f"kind = {TOTAL}").agg(*(F.sum(F.col("docs")[k]) for k in range(4))).first()]
    total, different, rest_total, rest_different = sums
    weights = mixture(learning_table(counted, rest_total, rest_different), rules)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        e = Estimates.of(pdf, "b")
        level, pair, word, chance = e.parts(total, different)
        w = weights[level]
        likely = np.log10(w[:, 0] * pair + w[:, 1] * word + w[:, 2] * chance)
        base = np.log10((e.word + rules.base_add) / (total + rules.base_add * (different + 1)))
        at = np.cumsum(e.length) - e.length
        return pd.DataFrame({"doc": pd.array(e.docs, "Int64"), "held_out": e.held, "n_tokens": e.length, "n_known": np.add.reduceat((e.word > 0).astype(np.int64), at),
                             "train_tokens": total, "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(likely, at)})

    return counted.where(f"kind <> {TOTAL}").groupBy("block").applyInPandas(
        run, "doc long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(docs: DataFrame) -> DataFrame:
    return score(docs).withColumnRenamed("doc", "doc_id")
