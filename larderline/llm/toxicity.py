"""Toxic passages as maximum-scoring segments of token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import fold, fresh, raw, slices, with_fields

EULER = 0.5772156649015329
KNOWN_WORDS = 1 << 18
STEP, BINS = 0.125, 128   # histogram of word scores
#: A-Z in lower case, other ASCII signs but digits as blanks.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@dataclass(frozen=True)
class ToxicityRules:
    slot_bits: int = 20           # words and their beginnings share 2**slot_bits scores: the model has a fixed size
    beginnings: tuple[int, ...] = (4, 5, 6, 7)  # code points of a word's beginnings, which inflected forms share
    sample_rows: int = 10_000     # bound of the labelled rows of each class that are learned from
    least_rows: int = 3           # toxic texts that a slot has to be in
    prior_rows: float = 100.0     # weight of the background in the Dirichlet prior, in texts
    flat: float = 0.5             # and what each slot has besides
    doubt: float = 3.0            # log-odds count as far as they exceed so many standard errors
    drift: float = 0.1            # each word costs so much, so that passages end
    e_value: float = 0.05         # passages expected so seldom by chance in the text are significant


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a text: letters and digits, A-Z lower-cased."""
    return (text or b"").translate(PLAIN).split()


def slots(word: bytes, rules: ToxicityRules) -> list[int]:
    """Slots of a word and of its beginnings."""
    mask, letters = (1 << rules.slot_bits) - 1, word.decode("utf-8", "replace")
    return [crc32(word) & mask] + [crc32(f"{letters[:n]}-".encode()) & mask for n in rules.beginnings if n < len(letters)]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in one pass (Ruzzo and Tompa).

    Each is the best segment of what the better ones leave. Steps of the pass are runs of positive scores; a candidate
    points to the nearest one before that starts lower, so that no step looks back further than it takes away.
    """
    up = scores > 0
    if not up.any():
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    edge = np.diff(np.concatenate(([0], up.astype(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    stack: list[list] = []
    for a, b, low, high in zip(begin.tolist(), end.tolist(), total[begin].tolist(), total[end].tolist()):
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append([a, b, low, high, j])
                break
            a, low, before = stack[j][0], stack[j][2], stack[j][4]
            del stack[j:]
            j = before
    return [(a, b, high - low) for a, b, low, high, _ in stack]


def rarity(normal: np.ndarray) -> float:
    """Minus the logarithm of the chance that clean text of this length has segments like these.

    The sum of the r best normalised scores follows the law of sums of extreme values; the r that is least likely
    counts. Negative, by how much even the best segment falls short of what is usual, where no segment stands out.
    """
    if not len(normal):
        return -20.0
    top = np.sort(normal)[::-1]
    r, total = np.arange(1, len(top) + 1), np.cumsum(top)
    logs = np.concatenate(([0.0], np.cumsum(np.log(r))))           # logarithms of factorials
    safe = np.maximum(total, 1e-9)
    seldom = np.where(total > r, total - (r - 1) * np.log(safe) + logs[r] + logs[r - 1], -np.inf)
    return float(np.clip(max(top[0], seldom.max()), -20, 1e4))


def squeezed(seldom):
    """Scale of the link: proportional where it decides, flat far beyond."""
    return np.sign(seldom) * np.log1p(np.abs(seldom))


@dataclass
class ToxicityModel:
    scores: np.ndarray     # of each slot: 0 or more, without drift
    lam: float             # scale of the extreme-value law of the best segment's score in clean text
    log_k: float
    slope: float           # logistic link from the rarity of a text's segments to its score
    offset: float
    rules: ToxicityRules

    def of(self, words: list[bytes]) -> np.ndarray:
        """Score of each word: the highest of its slots. Words are looked up once in a worker, as far as they are remembered."""
        known = self.__dict__.setdefault("known", {})
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = float(self.scores[slots(w, self.rules)].max())
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def passages(self, text: bytes | None) -> tuple[list[tuple[int, int, float, float]], float]:
        """Significant passages (first word, word after, score, E-value), and the rarity of the text's segments together."""
        of_words = self.of(tokens(text))
        found = segments(of_words - self.rules.drift)
        level = self.log_k + np.log(max(len(of_words), 1))
        rated = [(a, b, s, float(np.exp(min(level - self.lam * s, 50.0)))) for a, b, s in found]
        return [x for x in rated if x[3] <= self.rules.e_value], rarity(self.lam * np.array([s for *_, s in found]) - level)

    def probability(self, seldom: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.offset + self.slope * squeezed(seldom), -500, 500))))


def sample_of(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, train: Column, rules: ToxicityRules) -> tuple[DataFrame, np.ndarray]:
    """(text, toxic) of at most ``sample_rows`` labelled rows of each class, chosen by hash of the id; and for how many
    labelled rows of the whole table one of the sample stands, clean and toxic."""
    known = labels.where(train & F.col("toxic").isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg((F.max("toxic") == 1).cast("int").alias("toxic"))
    order = [F.xxhash64("id"), F.col("id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(rules.sample_rows).union(known.where("toxic = 0").orderBy(*order).limit(rules.sample_rows))
    count = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    stands_for = np.array([max(count.get(k, 0) / max(rules.sample_rows, 1), 1.0) for k in (0, 1)])
    # bounded by twice sample_rows, whatever the size of the tables
    sample = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), "id").select("text", "toxic")
    return sample, stands_for


def slot_scores(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, rules: ToxicityRules, stands_for: np.ndarray = np.ones(2)) -> np.ndarray:
    """Log-odds of texts with a slot, toxic against clean, with an informative Dirichlet prior, as far as they are beyond doubt.

    The prior's background has the classes in their shares of the whole table."""
    of_clean, of_toxic = stands_for
    prior = rules.prior_rows * (of_toxic * toxic + of_clean * clean) / max(of_toxic * n_toxic + of_clean * n_clean, 1) + rules.flat
    total = rules.prior_rows + 2 * rules.flat
    odds = np.log((toxic + prior) / (n_toxic + total - toxic - prior)) - np.log((clean + prior) / (n_clean + total - clean - prior))
    return np.maximum(0, odds - rules.doubt * np.sqrt(1 / (toxic + prior) + 1 / (clean + prior)))


def scale_of(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum(share * exp(x * score)) = 1: the rate at which high segments get rare."""
    if not (scores > 0).any():
        return 1.0
    low, high = 0.0, 1.0
    mean = lambda x: float((share * np.exp(np.minimum(x * scores, 500))).sum())
    while mean(high) < 1 and high < 1e3:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 1 else (low, mid)
    return high


def link(normal: np.ndarray, toxic: np.ndarray, stands_for: np.ndarray = np.ones(2)) -> tuple[float, float]:
    """Slope and offset of a ridge logistic fit, in which each class weighs as in the whole table."""
    if not len(normal) or toxic.min() == toxic.max():
        return 0.0, (50.0 if len(normal) and toxic.min() == 1 else -50.0)
    mid, spread = normal.mean(), max(normal.std(), 1e-9)
    x = np.stack([(normal - mid) / spread, np.ones(len(normal))], 1)
    weight = stands_for[toxic]
    weight = weight * len(weight) / weight.sum()
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + np.diag([1.0, 1e-6]), x.T @ (weight * (p - toxic)) + np.array([1.0, 1e-6]) * beta)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / spread), float(beta[1] - beta[0] * mid / spread)


def train_model(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", train: Column | None = None, rules: ToxicityRules = ToxicityRules()) -> ToxicityModel:
    """Learn from a bounded sample of labelled rows, in two passes over it: word counts, then the best segments.

    The law of best segments in clean text has its scale from the scores of words in the sample's clean texts, and its
    location from their best segments. Where the bound cuts a class, its rows weigh in the prior and the link as many as
    they stand for, so that the threshold doesn't move with the size of the table. Equal texts count once. Rows with a null label, id or text teach nothing; a label other than 1 is clean; of labels that
    disagree, the highest counts.
    """
    sample, stands_for = sample_of(docs, labels, doc_id, text, F.lit(True) if train is None else train, rules)
    sample = sample.dropDuplicates(["text", "toxic"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            slot, toxic = [], []
            for t, label in zip(raw(batch, "text"), batch.column("toxic").to_pylist()):
                own = {x for w in set(tokens(t)) for x in slots(w, rules)}
                slot += [-1, *own]       # -1 counts the texts
                toxic += [label] * (len(own) + 1)
            slot, toxic = np.array(slot, np.int64), np.array(toxic, np.int64)
            found, at = np.unique(slot, return_inverse=True)
            both = np.bincount(at, minlength=len(found))
            bad = np.bincount(at, weights=toxic, minlength=len(found)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"slot": found, "toxic": bad, "clean": both - bad})

    rows = (sample.mapInArrow(count, "slot long, toxic long, clean long").groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .where((F.col("slot") < 0) | (F.col("toxic") >= rules.least_rows)).toPandas())  # a row a slot at most
    texts, rows = rows[rows["slot"] < 0], rows[rows["slot"] >= 0]
    scores = np.zeros(1 << rules.slot_bits, np.float32)
    if len(texts):
        scores[rows["slot"].to_numpy(np.int64)] = slot_scores(rows["toxic"].to_numpy(float), rows["clean"].to_numpy(float), int(texts["toxic"].iloc[0]), int(texts["clean"].iloc[0]), rules, stands_for)
    first = ToxicityModel(scores, 1.0, 0.0, 1.0, 0.0, rules)
    sent = docs.sparkSession.sparkContext.broadcast(first)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in slices(batches):
            out = []
            for t, label in zip(raw(batch, "text"), batch.column("toxic").to_pylist()):
                of_words = m.of(tokens(t))
                histogram = np.bincount(np.minimum(of_words / STEP, BINS - 1).astype(np.int64), minlength=BINS).astype(np.int32)
                high = np.array([x for *_, x in segments(of_words - m.rules.drift)])
                out.append((label, len(of_words), high.tobytes(), histogram.tobytes()))
            yield pa.RecordBatch.from_pydict({k: pa.array([x[i] for x in out], kind) for i, (k, kind) in enumerate((("toxic", pa.int32()), ("n", pa.int64()), ("high", pa.binary()), ("histogram", pa.binary())))})

    # a short row for each of the sample: a text's segments are no more than its words of positive score
    found = sample.mapInArrow(best, "toxic int, n long, high binary, histogram binary").toPandas()
    is_clean = (found["toxic"] == 0).to_numpy()
    words = np.stack([np.frombuffer(bytes(x), np.int32) for x in found["histogram"]]).astype(float) if len(found) else np.zeros((0, BINS))
    in_clean = words[is_clean].sum(0) + 0.5 * (words.sum(0) > 0)   # scores that no clean text has are rare, not impossible
    lam = scale_of(STEP * np.arange(BINS) - rules.drift, in_clean / max(in_clean.sum(), 1))
    normal = [lam * np.frombuffer(bytes(h)) - np.log(max(n, 1)) for h, n in zip(found["high"], found["n"])]
    best_of = np.array([x.max() for x, c in zip(normal, is_clean) if c and len(x)])
    log_k = float(best_of.mean() - EULER) if len(best_of) else 0.0
    together = np.array([rarity(x - log_k) for x in normal])
    slope, offset = link(squeezed(together), found["toxic"].to_numpy(), stands_for)
    return ToxicityModel(scores, lam, log_k, slope, offset, rules)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` without the text, with score (0 to 1), predicted (1 from 0.5 on) and passages.

    passages: the significant toxic passages as (start, end: words, score, e_value). A null or empty text has no
    passage and the score of a text of one harmless word. Whole texts are read, one at a time; repeated rows get equal
    answers; columns of the added names are replaced; an empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted", "passages", text)]
    key = fresh(docs, "text_in")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**slot_bits scores
    struct = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in slices(batches):
            found = [m.passages(t) for t in raw(batch, key)]
            p = [m.probability(n) for _, n in found]
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in kept} | {
                "score": pa.array(p, pa.float64()), "predicted": pa.array([int(x >= 0.5) for x in p], pa.int32()),
                "passages": pa.array([[dict(zip(("start", "end", "score", "e_value"), x)) for x in passages] for passages, _ in found], struct)})

    made = "score double, predicted int, passages array<struct<start: bigint, end: bigint, score: double, e_value: double>>"
    return docs.select(*kept, F.col(text).cast("string").alias(key)).mapInArrow(run, with_fields(docs, kept, made))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and passages of every document; learned from labels that aren't held out."""
    held = fold("doc_id", 5) == 0
    model = train_model(docs, labels, train=~held)
    return score(docs.select("doc_id", held.alias("held_out"), "text"), model)
