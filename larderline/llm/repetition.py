"""Quality rules on repetition: characters inside repeated n-grams and lines, by rolling hashes of several lengths."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import fresh, raw, slices, with_fields, words

SYMBOLS = b"#*$%&|<>"
BASE = np.uint64(0x100000001B3)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")


@dataclass(frozen=True)
class RepetitionRules:
    min_words: int = 50
    repeat_window: int = 3            # words of the base rule's windows
    max_repeat: float = 0.5           # share of words in repeated windows, base rule
    #: Shares of characters from which a text is too repetitive, by n-gram length.
    top: tuple = ((2, 0.20), (3, 0.18), (4, 0.16))                                              # the most frequent n-gram
    repeated: tuple = ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10))      # n-grams seen before
    max_dup_line_chars: float = 0.20  # characters in lines equal to an earlier one
    max_symbols: float = 0.10         # signs of SYMBOLS for each word


def scrambled(ids: np.ndarray) -> np.ndarray:
    """A 64-bit value for each word number, as the digits of the rolling hashes."""
    x = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def covered(n_words: int, at: np.ndarray, length: int) -> np.ndarray:
    """Which words lie in windows of ``length`` words that start at ``at``."""
    edge = np.zeros(n_words + 1, np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:-1]) > 0


def exact_windows(ids: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the windows of ``length`` words: equal for equal windows only."""
    n = len(ids) - length + 1
    out = ids[:max(n, 0)]
    for k in range(1, length):
        pair = out * (int(ids.max()) + 1) + ids[k:k + n] if len(ids) else out
        out = np.unique(pair, return_inverse=True)[1] if k < length - 1 and int(ids.max() + 1) ** (k + 2) >= 1 << 62 else pair
    return out


def measure(text: bytes | None, rules: RepetitionRules) -> dict:
    """All counts of one text, and ``top`` and ``repeated``: shares of its characters by n-gram length."""
    text = text or b""
    w = words(text)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(x, len(seen)) for x in w), np.int64, len(w))
    data = np.frombuffer(text, np.uint8)
    first = (data & 0xC0) != 0x80
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    chars_of = np.array([len(x.decode("utf-8", "replace")) for x in seen] or [0], np.int64)
    chars = chars_of[ids] if len(ids) else ids
    total = int(first.sum() - blank.sum())

    lines: set[bytes] = set()
    n_dup = dup_chars = 0
    for line in text.split(b"\n"):
        if line.strip():
            if line in lines:
                n_dup += 1
                dup_chars += len(line.decode("utf-8", "replace")) - sum(line.count(b) for b in b" \t\r\x0b\x0c")
            lines.add(line)
    out = {"n_words": len(w), "word_chars": total, "n_symbols": sum(text.count(bytes([b])) for b in SYMBOLS), "n_dup_lines": n_dup,
           "dup_line_chars": dup_chars, "n_repeat_words": 0, "top": {}, "repeated": {}}

    k = rules.repeat_window
    if len(w) >= k:
        keys = exact_windows(ids, k)
        _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
        at = np.flatnonzero(count[inverse] > 1)
        if len(at):
            out["n_repeat_words"] = int(covered(len(w), at, k).sum())

    top, repeated = dict(rules.top), dict(rules.repeated)
    digits, rolling = scrambled(ids), np.zeros(0, np.uint64)
    for n in range(1, max((*top, *repeated)) + 1):
        if len(w) < n:
            break
        rolling = digits if n == 1 else rolling[:-1] * BASE + digits[n - 1:]
        if n not in top and n not in repeated:
            continue
        if n in repeated and out["repeated"] and not any(out["repeated"].values()) and n - 1 in repeated:
            break  # a repeated n-gram holds a repeated one of each shorter length
        _, where, inverse, count = np.unique(rolling, return_index=True, return_inverse=True, return_counts=True)
        if n in top:
            most = count.max()
            if most > 1:   # of equally frequent n-grams, the one with most characters
                span = np.cumsum(np.concatenate(([0], chars)))
                sizes = (span[n:] - span[:-n])[where]
                best = np.flatnonzero(count == most)[np.argmax(sizes[count == most])]
                inside = covered(len(w), np.flatnonzero(inverse == best), n)
                out["top"][n] = float(chars[inside].sum() / total)
            else:
                out["top"][n] = 0.0
        if n in repeated:
            again = np.ones(len(rolling), bool)
            again[where] = False
            at = np.flatnonzero(again)
            out["repeated"][n] = float(chars[covered(len(w), at, n)].sum() / total) if len(at) else 0.0
    return out


def base_failed(m: dict, rules: RepetitionRules) -> bool:
    return m["n_words"] < rules.min_words or m["n_repeat_words"] > rules.max_repeat * m["n_words"]


def repetitive(m: dict, rules: RepetitionRules) -> str:
    """The first rule that a text breaks, or an empty string."""
    for n, most in rules.top:
        if m["top"].get(n, 0) > most:
            return f"top_{n}_gram"
    for n, most in rules.repeated:
        if m["repeated"].get(n, 0) > most:
            return f"repeated_{n}_grams"
    if m["n_symbols"] > rules.max_symbols * m["n_words"]:
        return "symbols"
    if m["word_chars"] and m["dup_line_chars"] > rules.max_dup_line_chars * m["word_chars"]:
        return "dup_line_chars"
    return ""


def judge(docs: DataFrame, text: str = "text", rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """``docs`` without the text, and the measures, base_failed, kept, broken (the first rule that was broken).

    Words lie between ASCII blanks. A null or empty text has no words and fails the base rules. Repeated rows get equal
    answers. Whole texts are read, one at a time. Columns of the added names are replaced; an empty table gives an
    empty result. Of equally frequent n-grams the one with most characters is the top one.
    """
    made = (*MEASURES, "base_failed", "kept", "broken")
    kept = [c for c in docs.columns if c not in made and c != text]
    key = fresh(docs, "text_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [measure(t, rules) for t in raw(batch, key)]
            failed, broken = [base_failed(m, rules) for m in found], [repetitive(m, rules) for m in found]
            out = {c: batch.column(c) for c in kept} | {c: pa.array([m[c] for m in found], pa.int64()) for c in MEASURES}
            yield pa.RecordBatch.from_pydict(out | {"base_failed": pa.array(failed, pa.bool_()), "kept": pa.array([not f and not b for f, b in zip(failed, broken)], pa.bool_()), "broken": pa.array(broken, pa.string())})

    fields = with_fields(docs, kept, ", ".join([*(f"{c} long" for c in MEASURES), "base_failed boolean, kept boolean, broken string"]))
    return docs.select(*kept, F.col(text).cast("string").alias(key)).mapInArrow(run, fields)


def query(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "broken")
