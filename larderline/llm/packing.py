"""Packing token sequences: bounded-space online best fit in each partition.

A partition keeps a fixed number of open windows. Each document goes, whole, to the open window where it leaves the
least room. Where it fits in none, a new window opens; if all are open, the fullest is filled up with the head of the
document and leaves, and the rest of the document goes on. At the end the leftover windows of the partition merge, and
the last of them is cut at powers of two, which need no padding. Memory is the open windows and one document. Nothing
is shuffled, and a lost task repeats with the same rows.
"""

from __future__ import annotations

import itertools
import unicodedata
from array import array
from bisect import bisect_left, insort
from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import raw, slices


@dataclass(frozen=True)
class PackRules:
    length: int = 4096           # tokens of a sequence
    windows: int = 64            # open windows of a partition
    end_id: int = 2              # closes each document
    known_words: int = 1 << 17   # words whose ids a task remembers, twice over, before it starts anew
    rows_bits: int = 40          # sequences of a partition are numbered below 2**bits


#: Signs of ASCII but the apostrophe, which starts endings of its own.
SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
#: Fixed rule of byte-level vocabularies: visible bytes stand for themselves, the others follow from 256 on.
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {b: b for b in VISIBLE} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(VISIBLE))}


def plain_letters(word: bytes) -> bool:
    """Only letters, none that is a capital or can be composed."""
    try:
        text = word.decode()
    except UnicodeDecodeError:
        return False
    return text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text)


class WordTokenizer:
    """Ids of a text by a word-wise tokenizer file of the ``tokenizers`` library.

    Such a tokenizer drops white space, never joins over it and takes no heed of A-Z being capitals, so that the ids of
    a text are those of its words; each different word is tokenized once. A worker keeps what it knows for later tasks.
    """
    kept: dict[str, "WordTokenizer"] = {}

    def __init__(self, path: str, known_words: int):
        from tokenizers import Tokenizer
        self.model, self.known, self.before, self.limit = Tokenizer.from_file(path), {}, {}, known_words
        self.merge = self.model.model.tokenize
        # whether runs of letters and of signs go to the merges as they are, byte for byte
        self.plain = all(self.short(w) == array("I", self.model.encode(w.decode(), add_special_tokens=False).ids).tobytes() for w in (b"abcxyz", "äßéñç".encode(), b"zz", b"###!!"))

    def short(self, word: bytes) -> bytes:
        return array("I", [t.id for t in self.merge(word.decode("latin-1").translate(BYTE_SIGNS))]).tobytes()

    @classmethod
    def of(cls, path: str, known_words: int) -> "WordTokenizer":
        if path not in cls.kept or cls.kept[path].limit != known_words:
            cls.kept[path] = cls(path, known_words)
        return cls.kept[path]

    def ids(self, word: bytes) -> bytes:
        """Ids of a word, as 32-bit numbers one after the other."""
        found = self.known.get(word) or self.before.get(word)
        if found is None:
            head = word.rstrip(SIGNS)
            if len(head) < len(word) and head[-1:].isalnum() and b"<|" not in word:  # signs after a letter or digit are on their own
                found = self.ids(head) + self.ids(word[len(head):])
            elif self.plain and (word.isalpha() and word.islower() or not head and b"<|" not in word or plain_letters(word)):
                found = self.short(word)
            else:
                found = array("I", self.model.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()
        self.known[word] = found
        return found

    def __call__(self, text: bytes) -> np.ndarray:
        words = (text if b"<|" in text else text.lower()).split()  # in capitals, a special token is plain text
        if len(self.known) > self.limit:  # the words known so far are asked once more before they go
            self.known, self.before = {}, self.known
        known, before = self.known, self.before.get
        for w in set(words):
            if w not in known:
                known[w] = before(w) or self.ids(w)
        return np.frombuffer(b"".join(map(known.__getitem__, words)), np.uint32)


class Windows:
    """Open windows by free room; ``emit`` gets the pieces of a window that leaves, in order."""

    def __init__(self, rules: PackRules, emit: Callable[[list], None]):
        self.rules, self.emit = rules, emit
        self.rooms: list[tuple[int, int]] = []      # (free room, window), sorted
        self.pieces: dict[int, list] = {}
        self.next = 0

    def put(self, piece, size: int, cut: Callable) -> None:
        """Place a piece of ``size`` tokens; ``cut(piece, a, b)`` is its part from token a to b."""
        done = 0
        while size - done >= self.rules.length:      # whole windows of their own
            self.emit([cut(piece, done, done + self.rules.length)])
            done += self.rules.length
        while done < size:
            rest = size - done
            at = bisect_left(self.rooms, (rest, -1))
            if at == len(self.rooms) and len(self.rooms) < self.rules.windows:
                self.pieces[self.next] = []
                insort(self.rooms, (self.rules.length, self.next))
                self.next += 1
                at = bisect_left(self.rooms, (rest, -1))
            if at == len(self.rooms):                # fits in none: the fullest takes what it can hold
                at = 0
            room, window = self.rooms.pop(at)
            take = min(rest, room)
            self.pieces[window].append(cut(piece, done, done + take))
            done += take
            if take == room:
                self.emit(self.pieces.pop(window))
            else:
                insort(self.rooms, (room - take, window))

    def close(self, size_of: Callable, cut: Callable) -> None:
        """Merge the leftover windows, largest first, and cut the last at powers of two."""
        left = [self.pieces[w] for _, w in self.rooms]
        self.rooms, self.pieces = [], {}
        line: list = []
        held = 0

        def leave(length: int) -> None:
            nonlocal line, held
            out, got = [], 0
            while got < length:
                piece = line.pop(0)
                n = min(size_of(piece), length - got)
                out.append(cut(piece, 0, n))
                if n < size_of(piece):
                    line.insert(0, cut(piece, n, size_of(piece)))
                got += n
            held -= length
            self.emit(out)

        for pieces in left:
            line += pieces
            held += sum(map(size_of, pieces))
            if held >= self.rules.length:
                leave(self.rules.length)
        while held:
            leave(1 << (held.bit_length() - 1))


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", rules: PackRules = PackRules()) -> DataFrame:
    """Pieces of packed sequences: doc, start, length, ids (binary: little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    The tokens of a document are its ids and ``rules.end_id``. Each is in exactly one piece; start is its number of
    tokens before the piece, offset the sequence's. A sequence has at most ``rules.length`` tokens, and those with
    fewer have a power of two of them, so that none needs padding. sequence_id is unique over all partitions.

    A null or empty text is the end id alone. Rows that repeat an id or text are documents of their own. A null id stays
    null. Texts are read whole. Other columns aren't read. An empty table gives an empty result. Order within a
    partition decides the places; the result differs with the dealing of rows, its properties don't.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordTokenizer.of(tokenizer, rules.known_words)
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << rules.rows_bits
        numbers = itertools.count(first)
        rows: list[tuple] = []
        held = 0

        def emit(pieces: list) -> None:
            nonlocal held
            number, offset = next(numbers), 0
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total, number, offset))
                offset += len(ids)
            held += offset

        def batch_of() -> pa.RecordBatch:
            nonlocal rows, held
            columns = list(zip(*rows)) or [()] * 7
            rows, held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k == 3 else pa.int64()) for k, c in enumerate(columns)],
                                              ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        cut = lambda p, a, b: (p[0], p[1] + a, p[2][a:b], p[3])
        windows = Windows(rules, emit)
        for batch in slices(batches):
            for doc, t in zip(batch.column("doc").to_pylist(), raw(batch, "text")):
                ids = np.append(encode(t or b""), np.uint32(rules.end_id)).astype(np.uint32)
                windows.put((doc, 0, ids, len(ids)), len(ids), cut)
                if held > 1 << 20:
                    yield batch_of()
        windows.close(lambda p: len(p[2]), cut)
        yield batch_of()

    slim = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces with a checksum of their ids in place of these."""
    return pack(docs, tokenizer).select(F.col("doc").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
