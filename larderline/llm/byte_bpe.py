"""Byte-level BPE encoding and decoding by prefix dynamic programming.

Every prefix of a byte string has one encoding, and so one last token. A token that ends at a byte is the last one of
the prefix there if it and the last token of what stands before it stay as they are when both are merged together. The
last tokens of all prefixes are stored: the ids follow by stepping back from the end, bytes can be appended without
touching what is there, and after an edit only the bytes near it are worked on again. The cost is linear in the bytes,
also in a word of a million letters.
"""

from __future__ import annotations

import base64
import itertools
from array import array
from bisect import bisect_left
from dataclasses import dataclass
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import raw, slices, with_fields


@dataclass(frozen=True)
class BpeRules:
    ranks: str                   # a file of ranks: a line a token, base64 of its bytes and its id
    pattern: str                 # what a text is split by; each match is encoded by itself
    known_pieces: int = 1 << 17  # pieces whose ids a worker remembers, twice over, before it starts anew
    known_pairs: int = 1 << 18   # pairs of tokens that it remembers before it starts anew
    block: int = 1 << 15         # pieces of a text that are held at a time
    ahead: int = 2               # characters after its end that a match may depend on, besides blanks that follow each other


class Known(dict):
    """Ids of pieces, as bytes of 32-bit numbers. What is not here is asked from those ``before``, or worked out."""

    def __init__(self, vocabulary: "Vocabulary", before: dict | None = None):
        super().__init__()
        self.vocabulary, self.before = vocabulary, dict(before or {})

    def __missing__(self, piece: str) -> bytes:
        self[piece] = found = self.before.get(piece) or self.vocabulary.piece(piece.encode()).tobytes()
        return found


class Vocabulary:
    """Ranks with what the dynamic programme asks of them. A worker keeps a vocabulary for later tasks."""
    kept: dict[BpeRules, "Vocabulary"] = {}

    def __init__(self, rules: BpeRules):
        with open(rules.ranks, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.split, self.rules = regex.compile(rules.pattern), rules
        self.pairs: dict[int, bool] = {}
        self.ends: dict = {}     # tokens by their bytes from the last to the first: byte -> (id or None, deeper or None)
        for token, rank in self.ranks.items():
            if self.merged(token) == [rank]:  # others stand only where a whole piece equals them
                node = self.ends
                for b in token[:0:-1]:
                    found = node.setdefault(b, [None, None])
                    node = found[1] = found[1] or {}
                node.setdefault(token[0], [None, None])[0] = rank
        self.known = Known(self)

    @classmethod
    def of(cls, rules: BpeRules) -> "Vocabulary":
        if rules not in cls.kept:
            cls.kept[rules] = cls(rules)
        return cls.kept[rules]

    def merged(self, data: bytes) -> list[int]:
        """Ids of a few bytes by plain merging: always the pair of least rank, the first of two alike."""
        parts, get = [data[k:k + 1] for k in range(len(data))], self.ranks.get
        while True:
            rank, at = min(((r, k) for k in range(len(parts) - 1) if (r := get(parts[k] + parts[k + 1])) is not None), default=(None, 0))
            if rank is None:
                return [self.ranks[p] for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def stays(self, left: int, right: int) -> bool:
        """Whether two tokens beside each other stay as they are."""
        key = left << 32 | right
        if key not in self.pairs:
            if len(self.pairs) > self.rules.known_pairs:
                self.pairs.clear()
            self.pairs[key] = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return self.pairs[key]

    def prefixes(self, data: bytes, last: array | None = None) -> array:
        """The last token of each prefix of a piece; ``last`` has those of the first ones."""
        last, ends, pairs = array("I") if last is None else last, self.ends, self.pairs
        for end in range(len(last) + 1, len(data) + 1):
            found, at = ends.get(data[end - 1]), end - 1
            while found:
                token, node = found
                if token is not None and (not at or pairs.get(last[at - 1] << 32 | token) or self.stays(last[at - 1], token)):
                    last.append(token)
                    break
                at -= 1
                found = node.get(data[at]) if node and at >= 0 else None
            else:
                raise ValueError(f"byte {data[end - 1]} isn't in the vocabulary")
        return last

    def back(self, last: array) -> array:
        """Ids of a piece from the last tokens of its prefixes."""
        out, at = array("I"), len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.bytes_of[last[at - 1]])
        return out[::-1]

    def piece(self, data: bytes) -> array:
        """Ids of a piece. One that equals a token is that token."""
        rank = self.ranks.get(data)
        return array("I", [rank]) if rank is not None else self.back(self.prefixes(data))

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids of a text, a part after the other, as bytes of 32-bit numbers."""
        found = (m.group() for m in self.split.finditer(text)) if len(text) > self.rules.block else self.split.findall(text)
        for pieces in itertools.batched(found, self.rules.block):
            if len(self.known) > self.rules.known_pieces:
                self.known = Known(self, self.known)
            yield b"".join(map(self.known.__getitem__, pieces))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Draft:
    """A text under way, with the last tokens of the prefixes of each piece.

    ``append`` and ``replace`` give what encoding the whole new text anew would give. Pieces that an edit can't touch
    stay; from there on the text is split again until a piece begins where one began before, and of a piece that
    changes, the prefixes up to its first new byte stay. ``worked`` counts the bytes whose last token was looked for.
    """

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text, self.worked = vocabulary, "", 0
        self.start: list[int] = []      # where pieces begin, in characters
        self.last: list[array] = []     # the last token of each prefix of a piece
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, begin: int, end: int, new: str) -> None:
        """``new`` in place of the characters from ``begin`` to ``end``."""
        if not 0 <= begin <= end <= len(self.text):
            raise IndexError((begin, end, len(self.text)))
        old, before, shift = self.start, self.text, len(new) - (end - begin)
        self.text = before[:begin] + new + before[end:]
        first, rest = self.touched(before, begin), len(old)
        start: list[int] = []
        last: list[array] = []
        for match in self.vocabulary.split.finditer(self.text, old[first] if first < len(old) else 0):
            if match.start() >= begin + len(new):
                same = bisect_left(old, match.start() - shift)
                if same < len(old) and old[same] == match.start() - shift:
                    rest = same         # from here on, all is as it was
                    break
            k = first + len(start)
            known = (self.last[k], before[old[k]:self.end(before, k)]) if k < len(old) and old[k] == match.start() else None
            start.append(match.start())
            last.append(self.resumed(match.group().encode(), known))
        self.start[first:] = start + [s + shift for s in old[rest:]]
        self.last[first:] = last + self.last[rest:]

    def end(self, text: str, k: int) -> int:
        return self.start[k + 1] if k + 1 < len(self.start) else len(text)

    def touched(self, text: str, begin: int) -> int:
        """The first piece that a change at ``begin`` may touch: one that ends near it, or a run of blanks before it."""
        k = bisect_left(self.start, begin)
        while k > 0 and (self.end(text, k - 1) >= begin - self.vocabulary.rules.ahead or text[self.start[k - 1]:self.end(text, k - 1)].isspace()):
            k -= 1
        return k

    def resumed(self, data: bytes, known: tuple[array, str] | None) -> array:
        """Last tokens of a piece; those of the first bytes that the ``known`` piece has, too, are taken over."""
        last, same = known[0] if known else array("I"), 0
        if known:
            was = known[1].encode()
            most = min(len(data), len(was), len(last))
            differ = np.flatnonzero(np.frombuffer(data, np.uint8, most) != np.frombuffer(was, np.uint8, most))
            same = int(differ[0]) if len(differ) else most
        self.worked += len(data) - same
        return self.vocabulary.prefixes(data, last[:same])

    def ids(self) -> list[int]:
        v, out = self.vocabulary, []
        for last in self.last:
            ids = v.back(last)
            whole = v.ranks.get(v.decode(ids))
            out += ids if whole is None else [whole]
        return out


def renamed(df: DataFrame, names: list[str], columns: tuple[str, ...]) -> DataFrame:
    return df.select(*(F.col(n).alias(c) for n, c in zip(names, columns)), *df.columns[len(names):])


def encode(docs: DataFrame, rules: BpeRules, ids: tuple[str, ...] = ("doc_id",), text: str = "text", decoded: bool = False) -> DataFrame:
    """``ids`` of each row with n_tokens and token_ids (binary: little-endian unsigned 32-bit numbers).

    With ``decoded``, the bytes that the ids decode to besides, so that a table can be checked in one pass.

    Each match of ``rules.pattern`` in the text is encoded by itself; no string is a special token. A null or empty text
    has no token. Rows that repeat are rows of their own; null ids stay. Whole texts are read, a very long one in parts.
    Other columns aren't read, whatever their names. An empty table gives an empty result. Nothing is shuffled.
    """
    names = [f"c{k}" for k in range(len(ids))]
    slim = docs.select(*(F.col(c).alias(n) for c, n in zip(ids, names)), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(rules)
        for batch in slices(batches):
            out = [np.frombuffer(b"".join(vocabulary.encode((t or b"").decode("utf-8", "replace"))), np.uint32).astype("<u4").tobytes() for t in raw(batch, "text")]
            made = {"n_tokens": pa.array([len(x) // 4 for x in out], pa.int64()), "token_ids": pa.array(out, pa.binary())}
            if decoded:
                made["decoded"] = pa.array([vocabulary.decode(np.frombuffer(x, "<u4").tolist()) for x in out], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + list(made.values()), [*names, *made])

    return renamed(slim.mapInArrow(run, with_fields(slim, names, "n_tokens long, token_ids binary" + ", decoded binary" * decoded)), names, ids)


def decode(encoded: DataFrame, rules: BpeRules, columns: tuple[str, ...] = ("doc_id",), token_ids: str = "token_ids") -> DataFrame:
    """``columns`` of each row with decoded (binary), the bytes of its ids. Null ids of tokens give null; an id that the vocabulary doesn't have is an error."""
    names = [f"c{k}" for k in range(len(columns))]
    slim = encoded.select(*(F.col(c).alias(n) for c, n in zip(columns, names)), F.col(token_ids).cast("binary").alias("token_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(rules)
        for batch in slices(batches):
            out = [None if x is None else vocabulary.decode(np.frombuffer(x, "<u4").tolist()) for x in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(out, pa.binary())], [*names, "decoded"])

    return renamed(slim.mapInArrow(run, with_fields(slim, names, "decoded binary")), names, columns)


def edit(docs: DataFrame, rules: BpeRules, ids: tuple[str, ...] = ("doc_id",), text: str = "text", at: str = "at", removed: str = "removed", added: str = "added") -> DataFrame:
    """``ids`` of each row with the text after ``removed`` characters at character ``at`` gave way to ``added``, its token_ids, and worked:
    how many bytes the edit had looked at again.

    A null ``at`` is the end (an append), a null ``removed`` none, a null ``added`` or text empty. Places beyond the text count as its end.
    """
    names = [f"c{k}" for k in range(len(ids))]
    slim = docs.select(*(F.col(c).alias(n) for c, n in zip(ids, names)), *(F.col(c).cast("string").alias(n) for c, n in ((text, "text"), (added, "added"))),
                       *(F.col(c).cast("long").alias(n) for c, n in ((at, "at"), (removed, "removed"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(rules)
        for batch in slices(batches, 100):
            out = []
            for r in batch.select(["text", "added", "at", "removed"]).to_pylist():
                draft = Draft(vocabulary, r["text"] or "")
                begin = len(draft.text) if r["at"] is None else min(max(r["at"], 0), len(draft.text))
                before = draft.worked
                draft.replace(begin, min(begin + max(r["removed"] or 0, 0), len(draft.text)), r["added"] or "")
                out.append((draft.text, np.array(draft.ids(), "<u4").tobytes(), draft.worked - before))
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.int64()))],
                                             [*names, "text", "token_ids", "worked"])

    return renamed(slim.mapInArrow(run, with_fields(slim, names, "text string, token_ids binary, worked long")), names, ids)


def query(docs: DataFrame, rules: BpeRules) -> DataFrame:
    """Ids and the bytes that they decode to, as checksums."""
    return encode(docs, rules, decoded=True).select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
