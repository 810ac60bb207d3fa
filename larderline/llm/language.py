"""Language identification by error-correcting output codes over hashed letter n-grams."""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larderline.llm.common import fold, fresh, slices, with_fields

NONE = "und"
FREQUENT = 1000  # languages whose rows are thinned before the sample is chosen


@dataclass(frozen=True)
class LanguageRules:
    orders: tuple[int, ...] = (1, 2, 3)   # lengths of the letter n-grams
    hash_bits: int = 16                   # n-grams share 2**hash_bits weights
    sample_rows: int = 4000               # bound of the training sample, over all languages
    all_codes_up_to: int = 5              # languages for which every split into two sides is a bit
    random_bits: int = 10                 # bits per doubling of the number of languages beyond that
    prior: float = 0.5                    # added to each count of an n-gram
    damping: float = 0.2                  # n-grams of a text overlap, so their evidence counts less than independent one
    clear: float = 1.5                    # a text is ambiguous if the best share isn't so many times the next one
    piece: int = 1 << 20                  # code points worked on at once


class Letters:
    """Lower-case form of each code point, blank for all but letters. Built once in a worker."""
    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            table = np.full(0x110000, 32, np.uint32)
            for i in itertools.chain(range(0xD800), range(0xE000, 0x110000)):
                c = chr(i)
                if c.isalpha():
                    low = c.lower()
                    table[i] = ord(low) if len(low) == 1 else i
            cls.table = table
        return cls.table


def pieces(text: str, rules: LanguageRules) -> Iterator[tuple[int, np.ndarray]]:
    """Letters of the whole text, runs of other characters as one blank, in pieces that overlap by the longest n-gram;
    with each piece, how many of its code points were in the one before."""
    keep, used = max(rules.orders) - 1, 0
    tail = np.array([32], np.uint32)
    for at in range(0, len(text), rules.piece):
        cp = Letters.get()[np.frombuffer(text[at:at + rules.piece].encode("utf-32-le", "replace"), np.uint32)]
        last = at + rules.piece >= len(text)
        cp = np.concatenate((tail, cp, np.array([32] * last, np.uint32)))
        blank = cp == 32
        cp = cp[~(blank & np.concatenate(([False], blank[:-1])))]
        yield used, cp
        tail = cp[-keep:] if keep else cp[:0]
        used = len(tail)


def slots(cp: np.ndarray, order: int, bits: int, skip: int) -> np.ndarray:
    """Hash slots of the n-grams of one order; the first ``skip`` code points were used with the piece before."""
    n = len(cp) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, order, np.uint32)
    for k in range(order):
        h = (h ^ cp[k:k + n]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    h = h[max(0, skip - order + 1):]
    return (h >> np.uint32(32 - bits)).astype(np.int64)


def features(text: str, rules: LanguageRules) -> Iterator[np.ndarray]:
    """Slots of all n-grams of a text, piece by piece."""
    for used, cp in pieces(text, rules):
        yield np.concatenate([slots(cp, n, rules.hash_bits, used) for n in rules.orders])


def codewords(n: int, rules: LanguageRules) -> np.ndarray:
    """A row of +1 and -1 per language. Few languages: every split; many: seeded random bits, each row different."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= rules.all_codes_up_to:
        splits = range(1, 2 ** (n - 1))
        return np.array([[1 if s >> i & 1 else -1 for s in splits] for i in range(n)], np.int8)
    rng, width = np.random.default_rng(n), int(np.ceil(rules.random_bits * np.log2(n)))
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), size=(n, width))
        code[0, np.abs(code.sum(0)) == n] *= -1
        gram = code.astype(np.int32) @ code.T.astype(np.int32)
        distance = ((width - gram)[~np.eye(n, dtype=bool)]).min()
        if distance > apart:
            best, apart = code, distance
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray       # languages x bits, +1 or -1
    weights: np.ndarray    # slots x bits: log odds of each n-gram for the side +1
    trust: np.ndarray      # weight of each bit in decoding, by its accuracy on the sample
    rules: LanguageRules

    def margins(self, text: str) -> np.ndarray:
        total = np.zeros(self.code.shape[1])
        for at in features(text, self.rules):
            total += self.weights[at].sum(0, dtype=np.float64)
        return total * self.rules.damping

    def decode(self, margins: np.ndarray) -> tuple[int, float, bool]:
        """Nearest codeword by trust-weighted logistic loss, its share against all codewords, and whether it is ambiguous."""
        loss = (np.logaddexp(0, -self.code * margins[None, :]) * self.trust[None, :]).sum(1)
        best = int(np.argmin(loss))
        share = np.exp(np.clip(loss[best] - loss, -700, 0))
        return best, float(1 / share.sum()), len(share) > 1 and bool(np.partition(share, -2)[-2] * self.rules.clear > 1)


def sample_of(docs: DataFrame, doc_id: str, text: str, lang: str, train: Column, rules: LanguageRules) -> DataFrame:
    """At most ``rules.sample_rows`` labelled rows (text, lang), dealt evenly over the languages, chosen by hash of the id."""
    ids = docs.where(train & F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(lang).alias("lang"), F.col(doc_id).alias("id"))
    order = [F.xxhash64("id"), F.col("id")]
    # of a frequent language only ids with a low hash go on, about twice as many as can be chosen, so that no window
    # grows with the corpus; the counts of the most frequent languages are few rows, whatever the corpus
    frequent = ids.groupBy("lang").count().where(F.col("count") > 2 * rules.sample_rows).orderBy(F.desc("count"), "lang").limit(FREQUENT)
    low = F.pmod(F.xxhash64("id", F.lit("deal")), F.lit(1 << 30)) * F.col("count") < (2 * rules.sample_rows + 100) * (1 << 30)
    ids = ids.join(F.broadcast(frequent), "lang", "left").where(F.col("count").isNull() | low)
    ranked = ids.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("n") <= rules.sample_rows)
    chosen = ranked.orderBy("n", "lang", *order).limit(rules.sample_rows).select("id", F.col("lang").alias("of"))
    # bounded by sample_rows, whatever the size of the corpus
    return (docs.where(train).select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
            .join(F.broadcast(chosen), "id").where(F.col("lang") == F.col("of")).select("text", "lang"))


def train_model(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", train: Column | None = None,
                rules: LanguageRules = LanguageRules()) -> LanguageModel:
    """Fit the bit classifiers on a bounded sample of labelled rows.

    Tasks count the n-grams of each language; a language is one array of fixed length. Each bit of the code splits the
    languages into two sides, and its classifier is the log odds of an n-gram on one side against the other.
    """
    width = 1 << rules.hash_bits

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.int64)
        for t in pdf["text"]:
            for at in features(t, rules):
                total += np.bincount(at, minlength=width)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "counts": [total.tobytes()]})

    spread = sample_of(docs, doc_id, text, lang, F.lit(True) if train is None else train, rules).withColumn("part", F.pmod(F.xxhash64("text"), F.lit(4)))
    rows = spread.groupBy("lang", "part").applyInPandas(count, "lang string, counts binary").collect()
    languages = sorted({r["lang"] for r in rows})
    counts = np.zeros((len(languages), width))
    for r in rows:
        counts[languages.index(r["lang"])] += np.frombuffer(r["counts"], np.int64)
    share = (counts + rules.prior) / (counts.sum(1, keepdims=True) + rules.prior * width)  # each language weighs the same
    code = codewords(len(languages), rules)
    weights, trust = np.zeros((width, code.shape[1]), np.float32), np.ones(code.shape[1])
    for bit in range(code.shape[1] if len(languages) > 1 else 0):
        plus, minus = share[code[:, bit] > 0], share[code[:, bit] < 0]
        weights[:, bit] = np.log(plus.mean(0)) - np.log(minus.mean(0))
        per_language = (share * weights[:, bit]).sum(1) * code[:, bit]      # expected evidence for the right side
        trust[bit] = 1 / (1 + np.exp(-50 * per_language.min()))
    return LanguageModel(languages, code, weights, trust / max(trust.mean(), 1e-9), rules)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous, under these or other ``names``.

    lang_pred: the language of the nearest codeword; ``und`` (score 0) if the text is null or has no letter, or if no
    language was learned. ambiguous: the best share isn't
    ``rules.clear`` times the next one. Equal losses: the first language by name. Whole texts are read, long ones piece by piece.
    Repeated rows get equal answers; an empty table gives an empty result. Columns of these names are replaced.
    """
    kept = [c for c in docs.columns if c not in names]
    share = docs.sparkSession.sparkContext.broadcast(model)  # slots x bits, of fixed size
    key = fresh(docs, "text_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = share.value
        for batch in slices(batches):
            said, scores, unsure = [], [], []
            for t in batch.column(key).to_pylist():
                if not t or not m.languages or not any((cp != 32).any() for _, cp in pieces(t, m.rules)):
                    said.append(NONE)
                    scores.append(0.0)
                    unsure.append(False)
                    continue
                best, score, open_ = m.decode(m.margins(t))
                unsure.append(open_)
                said.append(m.languages[best])
                scores.append(score)
            out = {c: batch.column(c) for c in kept} | dict(zip(names, (
                pa.array(said, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_()))))
            yield pa.RecordBatch.from_pydict(out)

    made = ", ".join(f"`{n}` {kind}" for n, kind in zip(names, ("string", "double", "boolean")))
    return docs.select(*kept, F.col(text).cast("string").alias(key)).mapInArrow(run, with_fields(docs, kept, made))


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every document; learned from the documents that aren't held out."""
    held = fold("doc_id", 4) == 2
    model = train_model(docs, train=~held)
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")
