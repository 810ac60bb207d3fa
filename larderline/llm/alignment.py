"""Alignment of two tokenizers by products of token-byte incidence matrices.

A has a row a token of the byte-level vocabulary and a column a byte of the text, B the same for the piece vocabulary.
Both are compressed sparse rows built by hand. The row products of A and B transposed are the links: which tokens
overlap, and in how many bytes. Byte offsets where both have an end cut the text into groups; with incidence matrices of
tokens and groups, the product of the one and the other transposed links the tokens that share a group.

Neither tokenizer joins over a blank that follows a letter or sign, so that a text is the sequence of its segments, and each
different segment of a block of documents is tokenized and multiplied once, in one block-diagonal matrix. The counts of id
pairs over the corpus are sums over blocks; a block gets back the counts of its own pairs.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import raw, slices
from larderline.llm.lm_score import packed, unpacked
from larderline.session import cut


@dataclass(frozen=True)
class AlignRules:
    byte_level: str                  # a file of the ``tokenizers`` library with a byte-level vocabulary (A)
    pieces: str                      # a model file of the ``sentencepiece`` library (B)
    block_segments: int = 600_000    # a block of documents is full at so many segments,
    block_letters: int = 1 << 22     # or at so many letters of different ones
    known_segments: int = 1 << 17    # segments whose ids a worker remembers, twice over, before it starts anew
    expansion: int = 1 << 20         # elements of a row product that are worked on at a time
    id_bits: int = 20                # of a B id in the key of an id pair


@dataclass(frozen=True)
class Rows:
    """A sparse matrix in compressed rows."""
    start: np.ndarray      # where a row begins, and the end
    column: np.ndarray
    value: np.ndarray
    columns: int

    @classmethod
    def of_spans(cls, ends: np.ndarray, columns: int) -> "Rows":
        """Token-byte incidence: tokens follow each other and end at ``ends``."""
        return cls(np.concatenate(([0], ends)), np.arange(columns), np.ones(columns, np.int64), columns)

    @classmethod
    def of_members(cls, group: np.ndarray, groups: int) -> "Rows":
        """Token-group incidence: a token is in one group."""
        return cls(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), groups)

    def transposed(self) -> "Rows":
        order = np.argsort(self.column, kind="stable")
        row = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        return Rows(np.concatenate(([0], np.cumsum(np.bincount(self.column, minlength=self.columns)))), row[order], self.value[order], len(self.start) - 1)

    def sizes(self, other: "Rows") -> np.ndarray:
        """Elements of the row products before equal columns are added: for each row, the sum of ``other``'s row lengths."""
        ends = np.concatenate(([0], np.cumsum(np.diff(other.start)[self.column])))
        return ends[self.start[1:]] - ends[self.start[:-1]]

    def products(self, other: "Rows", expansion: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """self @ other by Gustavson's rule: a row of the product is the sum of ``other``'s rows at the row's columns.

        Yields (row, column, value), in order, for so many rows at a time that about ``expansion`` elements are open.
        """
        size = np.cumsum(self.sizes(other))
        first = 0
        while first < len(size):
            after = int(np.searchsorted(size, (size[first - 1] if first else 0) + expansion, "right"))
            after = max(after, first + 1)
            a, b = self.start[first], self.start[after]
            length = np.diff(other.start)[self.column[a:b]]
            ends = np.cumsum(length)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(other.start[self.column[a:b]] - ends + length, length)
            row = np.repeat(np.repeat(np.arange(first, after), np.diff(self.start[first:after + 1])), length)
            column, value = other.column[at], np.repeat(self.value[a:b], length) * other.value[at]
            key = row * other.columns + column
            if len(key) and (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, row, column, value = key[order], row[order], column[order], value[order]
            head = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
            yield row[head], column[head], np.add.reduceat(value, head) if len(head) else value
            first = after


#: Blanks, then other characters; on over blanks that don't begin with a space, and over those at the end.
SEGMENT = regex.compile(r"\s*+\S++(?:[^\S ]\s*+\S++)*+(?:\s++\Z)?|\s++")
#: Texts on which segments have to give what the whole gives.
PROBES = ("a b  c", "one\n two \t three\n\n  four  ", "it's <s> <|endoftext|>  x ", "é à 東京 🤖 ñ", " 12 34.5,6 - = ")


class Tokenizers:
    """Both vocabularies and the bytes of their tokens. A worker keeps them for later tasks."""
    kept: dict[tuple, "Tokenizers"] = {}

    def __init__(self, rules: AlignRules):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        from larderline.llm.packing import BYTE_SIGNS
        self.a = Tokenizer.from_file(rules.byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=rules.pieces)
        byte_of = {chr(sign): b for b, sign in BYTE_SIGNS.items()}
        size = self.a.get_vocab_size()
        tokens = [self.a.id_to_token(k) or "" for k in range(size)]
        self.bytes_a = [bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in tokens]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.now: dict[str, tuple[bytes, bytes] | None] = {}
        self.before: dict[str, tuple[bytes, bytes] | None] = {}
        self.words = [f"{k}{sign}".encode() for k in range(max(size, len(pieces))) for sign in ",|;"]
        self.word_size = np.array([len(w) for w in self.words])
        shape = json.loads(open(rules.byte_level, encoding="utf-8").read())
        split = (shape["pre_tokenizer"] or {}).get("type") == "ByteLevel" and shape["pre_tokenizer"].get("use_regex", True) and not shape["normalizer"]
        self.cuts = bool(split) and not any(regex.search("[^▁]▁", p) for p in pieces) and all(self.alike(t) for t in PROBES)

    @classmethod
    def of(cls, rules: AlignRules) -> "Tokenizers":
        key = rules.byte_level, rules.pieces
        if key not in cls.kept:
            cls.kept[key] = cls(rules)
        return cls.kept[key]

    def encoded(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids by A of segments, which begin with a space, and by B, which adds it itself."""
        return [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)], self.b.encode([s[1:] for s in segments], num_threads=1)

    def known(self, segments: list[str], limit: int) -> list[tuple[bytes, bytes] | None]:
        """Ids by both of each segment, as bytes of 32-bit numbers; None if they don't give back its bytes. Remembered for later blocks."""
        if len(self.now) > limit:  # those known so far are asked once more before they go
            self.now, self.before = {}, self.now
        now, before = self.now, self.before
        missing = []
        for s in segments:
            if s not in now:
                if s in before:
                    now[s] = before[s]
                else:
                    missing.append(s)
        for at in range(0, len(missing), 5_000):
            part = missing[at:at + 5_000]
            ended = [s for s in part if not s[-1].isspace()]   # others would run on into the next
            now.update(zip(ended, self.in_one(ended) or []))
            for s in part:
                if s not in now:
                    now[s] = (self.in_one([s]) or [None])[0]
        return [now[s] for s in segments]

    def in_one(self, segments: list[str]) -> list[tuple[bytes, bytes]] | None:
        """Ids by both of segments, tokenized as one text; None if the tokens don't give back its bytes, or one stands over an end."""
        if not segments:
            return []
        text, out = "".join(segments), []
        data, ends = text.encode(), np.cumsum([len(s.encode()) for s in segments])
        (a,), (b,) = self.encoded([text])
        for ids, sizes, bytes_of in ((a, self.size_a, self.bytes_a), (b, self.size_b, self.bytes_b)):
            if b"".join(map(bytes_of.__getitem__, ids)) != data:
                return None
            ids = np.array(ids, np.uint32)
            stop = np.cumsum(sizes[ids])
            after = np.searchsorted(stop, ends) + 1
            if not np.array_equal(stop[after - 1], ends):
                return None
            plain = ids.tobytes()
            out.append([plain[4 * x:4 * y] for x, y in zip([0, *after[:-1].tolist()], after.tolist())])
        return list(zip(*out))

    def alike(self, text: str) -> bool:
        whole, parts = self.encoded([" " + text]), self.encoded(SEGMENT.findall(" " + text))
        return all(w[0] == [k for ids in p for k in ids] for w, p in zip(whole, parts))

    def segments(self, text: str) -> list[str]:
        """The segments of a text behind a space; the whole where a tokenizer may join over them."""
        return SEGMENT.findall(" " + text) if self.cuts else [" " + text]


class Numbers(dict):
    """A number for each different text, in order of coming, and their letters together."""
    letters = 0

    def __missing__(self, key: str) -> int:
        self[key] = found = len(self)
        self.letters += len(key)
        return found


@dataclass
class Links:
    """What the products say about segments that follow each other."""
    sizes: np.ndarray        # rows n_a, n_b, n_groups, n_links, n_group_links; a column a segment
    key: np.ndarray          # id pair of each link, by segment
    groups: list[bytes]      # groups of each segment, as text that ends in a semicolon
    whole: np.ndarray        # whether the tokens' bytes are the segment's


def flat(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids that follow each other, and how many each entry has."""
    return np.frombuffer(b"".join(ids), np.uint32).astype(np.int64), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


def linked(segments: list[str], tokenizers: Tokenizers, rules: AlignRules) -> Links:
    """Links and groups of segments. One whose bytes a tokenizer doesn't give back has no tokens."""
    ids = tokenizers.known(segments, rules.known_segments)
    whole = np.fromiter((x is not None for x in ids), bool, len(ids))
    (a, n_a), (b, n_b) = (flat([x[side] if x else b"" for x in ids]) for side in (0, 1))
    number = len(segments)
    end_a, end_b = np.cumsum(tokenizers.size_a[a]), np.cumsum(tokenizers.size_b[b])
    size = int(end_a[-1]) if len(end_a) else 0
    of_a, of_b = Rows.of_spans(end_a, size), Rows.of_spans(end_b, size)
    found = [(i, j) for i, j, _ in of_a.products(of_b.transposed(), rules.expansion)] or [(np.zeros(0, np.int64),) * 2]
    i, j = (np.concatenate(x) for x in zip(*found))
    segment_a, segment_b = np.repeat(np.arange(number), n_a), np.repeat(np.arange(number), n_b)
    ends = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
    segment_of = segment_a[np.searchsorted(end_a, ends)]
    shared = Rows.of_members(group_a, len(ends)).sizes(Rows.of_members(group_b, len(ends)).transposed())
    count = lambda x, w=None: np.bincount(x, weights=w, minlength=number).astype(np.int64)
    sizes = np.stack([n_a, n_b, count(segment_of), count(segment_a[i]), count(segment_a, shared)])
    # groups as text: the tokens of A, then of B, group by group; a bar after the last of A, a semicolon after the last of B
    order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
    side = np.concatenate((2 * group_a, 2 * group_b + 1))[order]
    last = np.concatenate((side[1:] != side[:-1], [True]))[:len(side)]
    word = 3 * np.concatenate((a, b))[order] + np.where(last, 1 + side % 2, 0)
    text = b"".join([tokenizers.words[w] for w in word])
    after = np.cumsum(count(np.concatenate((segment_a, segment_b))[order], tokenizers.word_size[word]))
    return Links(sizes, (a[i] << rules.id_bits) + b[j], [text[x:y] for x, y in zip(np.concatenate(([0], after[:-1])).tolist(), after.tolist())], whole)


def sums(values: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Sums of parts of ``values`` that follow each other."""
    total = np.concatenate(([0], np.cumsum(values)))
    end = np.cumsum(length)
    return total[end] - total[end - length]


class Block:
    """Documents on the way into one block."""

    def __init__(self):
        self.known, self.docs, self.texts, self.size = Numbers(), [], [], 0

    def add(self, doc, text: bytes | None, tokenizers: Tokenizers) -> None:
        segments = tokenizers.segments(text.decode("utf-8", "replace")) if text else []
        self.texts.append(np.array(list(map(self.known.__getitem__, segments)), np.int32))
        self.docs.append(doc)
        self.size += len(segments)

    def row(self, number: int, tokenizers: Tokenizers, rules: AlignRules) -> dict:
        text = np.concatenate(self.texts)
        length = np.array([len(t) for t in self.texts])
        seen = np.bincount(text, minlength=len(self.known))
        order = np.argsort(-seen, kind="stable")     # frequent segments get small numbers, which pack well
        new = np.empty(len(order), np.int32)
        new[order] = np.arange(len(order))
        names = list(self.known)
        links = linked([names[k] for k in order], tokenizers, rules)
        text, seen = new[text], seen[order]
        told = sums(~links.whole[text], length) == 0
        kept = np.repeat(told, length)               # segments of documents that have tokens
        seen = np.bincount(text[kept], minlength=len(names))
        keys, where = np.unique(links.key, return_inverse=True)
        times = np.bincount(where, weights=np.repeat(seen, links.sizes[3]), minlength=len(keys)).astype(np.int64)
        ends = np.cumsum(length)
        digest = [hashlib.sha256(b"".join([links.groups[k] for k in text[e - n:e].tolist()])[:-1]).hexdigest() if n and t else "" for e, n, t in zip(ends, length, told)]
        sizes = np.stack([np.where(told, sums(s[text], length), 0) for s in links.sizes])
        return {"block": number, "keys": keys, "times": times, "docs": self.docs, "digest": digest, "sizes": packed(sizes.reshape(-1)),
                "length": packed(np.where(told, length, 0)), "text": packed(text[kept]), "links": packed(links.sizes[3]), "pairs": packed(where)}


SCHEMA = "block long, keys array<bigint>, times array<bigint>, docs array<bigint>, digest array<string>, sizes binary, length binary, text binary, links binary, pairs binary"
ARROW = pa.schema([("block", pa.int64()), ("keys", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())), ("digest", pa.list_(pa.string())),
                   *((n, pa.binary()) for n in ("sizes", "length", "text", "links", "pairs"))])


def blocks(docs: DataFrame, rules: AlignRules) -> DataFrame:
    """A row a block: its different id pairs with their links, and what its documents need to sum the corpus counts. ``docs``: doc, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, context = Tokenizers.of(rules), TaskContext.get()
        number, block = (context.partitionId() if context else 0) << 32, Block()
        for batch in slices(batches):
            for doc, text in zip(batch.column("doc").to_pylist(), raw(batch, "text")):
                block.add(doc, text, tokenizers)
                if block.size >= rules.block_segments or block.known.letters >= rules.block_letters:
                    yield pa.RecordBatch.from_pylist([block.row(number, tokenizers, rules)], ARROW)
                    number, block = number + 1, Block()
        if block.docs:
            yield pa.RecordBatch.from_pylist([block.row(number, tokenizers, rules)], ARROW)

    return docs.mapInArrow(run, SCHEMA)


def pair_counts(sent: DataFrame, rules: AlignRules) -> DataFrame:
    """key (of an id pair), count (its links over the corpus), best (whether no pair of its B id has more)."""
    counts = sent.select(F.inline(F.arrays_zip("keys", "times"))).where("times > 0").groupBy(F.col("keys").alias("key")).agg(F.sum("times").alias("count"))
    b = F.col("key") % (1 << rules.id_bits)
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))   # a row a B id
    return counts.withColumn("b", b).join(most, "b").select("key", "count", (F.col("count") == F.col("most")).alias("best"))


SIZES = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")


def align(docs: DataFrame, rules: AlignRules, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row a document: doc, n_a, n_b, n_groups, n_links, n_group_links, n_best, count_sum, groups_sha256.

    A is of a space and the text, B of the text, with a space of its own. Links are the pairs of an A and a B token that
    share a byte, group links those that share a group. The count of an id pair is its links over all documents;
    count_sum adds it up over the links of a document, n_best are the links whose count no pair of the same B id
    exceeds. groups_sha256 is of the ids by group, ``a1,a2|b1;a3|b2,b3``.

    A null or empty text, or one whose bytes a tokenizer doesn't give back, has no tokens: zeros and an empty digest.
    Null ids stay, rows that repeat are documents of their own. Whole texts are read, other columns aren't. An empty
    table gives an empty result. ``docs`` should be a stored table, as blocks are numbered by task.
    """
    slim = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    sent = cut(blocks(slim, rules))
    own = sent.select("block", F.explode("keys").alias("key"))
    back = own.join(pair_counts(sent, rules), "key").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("key", "count", "best"))).alias("back"))
    met = sent.drop("times").join(back, "block", "left").select(
        "keys", "docs", "digest", "sizes", "length", "text", "links", "pairs", *(F.col(f"back.{c}").alias(f"back_{c}") for c in ("key", "count", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = {n: batch.column(n)[0] for n in batch.schema.names}
            column = lambda n: row[n].values.to_numpy(zero_copy_only=False) if row[n].is_valid else np.zeros(0, np.int64)
            keys, found = column("keys"), column("back_key")
            count, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            at = np.searchsorted(keys, found)
            count[at], best[at] = column("back_count"), column("back_best")
            length, text, links, pairs = (unpacked(row[n].as_py()).astype(np.int64) for n in ("length", "text", "links", "pairs"))
            sizes = unpacked(row["sizes"].as_py()).astype(np.int64).reshape(len(SIZES), -1)
            of_doc = [sums(sums(v[pairs], links)[text], length) for v in (best, count)]
            yield pa.RecordBatch.from_arrays([row["docs"].values, *map(pa.array, [*sizes, *of_doc]), row["digest"].values], ["doc", *SIZES, "n_best", "count_sum", "groups_sha256"])

    return met.mapInArrow(run, f"doc long, {', '.join(f'{n} long' for n in SIZES)}, n_best long, count_sum long, groups_sha256 string")


def token_links(docs: DataFrame, rules: AlignRules, doc_id: str = "doc_id", text: str = "text", shared: bool = False) -> DataFrame:
    """A row a link: doc, a and b (places of the tokens), a_id, b_id, n: the bytes in which they overlap, in order of the tokens.

    With ``shared``, the links are those of tokens in one group, by the product of the group incidences; a group of many
    tokens gives all its pairs, some at a time. Documents without tokens (see ``align``) have no row.
    """
    names = ["doc", "a", "b", "a_id", "b_id", "n"]
    slim = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers.of(rules)
        for batch in slices(batches):
            for doc, t in zip(batch.column("doc").to_pylist(), raw(batch, "text")):
                if not t:
                    continue
                whole = " " + t.decode("utf-8", "replace")
                a, b = (np.array(x[0], np.int64) for x in tokenizers.encoded([whole]))
                if not b"".join([tokenizers.bytes_a[k] for k in a]) == whole.encode() == b"".join([tokenizers.bytes_b[k] for k in b]):
                    continue
                end_a, end_b = np.cumsum(tokenizers.size_a[a]), np.cumsum(tokenizers.size_b[b])
                of_a, of_b = Rows.of_spans(end_a, int(end_a[-1])), Rows.of_spans(end_b, int(end_a[-1]))
                if shared:
                    ends = np.intersect1d(end_a, end_b, assume_unique=True)
                    of_a, of_b = (Rows.of_members(np.searchsorted(ends, e), len(ends)) for e in (end_a, end_b))
                for i, j, n in of_a.products(of_b.transposed(), rules.expansion):
                    yield pa.RecordBatch.from_arrays([pa.array([doc] * len(i), pa.int64()), *map(pa.array, (i, j, a[i], b[j], n))], names)

    return slim.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def query(docs: DataFrame, rules: AlignRules) -> DataFrame:
    return align(docs, rules).select(F.col("doc").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links")
