"""Scores against plain counting, and the mixture's probabilities."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from larderline.llm import lm_score as S


def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    docs = []
    for i in range(250):
        w = [rng.choice(vocabulary)]
        for _ in range(rng.randint(0, 80)):
            w.append(vocabulary[(vocabulary.index(w[-1]) * 7 + rng.randint(0, 2)) % 60] if rng.random() < 0.7 else rng.choice(vocabulary))
        if rng.random() < 0.2:
            w.append(f"Rare{i}")
        docs.append((i, " \t".join(w)))
    return docs + [(900, None), (901, ""), (902, " \n"), (None, "a b"), (3, docs[3][1]), (903, "X\x1cy é")]


def fold(i):
    return 0 if i is None else zlib.crc32(str(i).encode()) % 10


def tokens(t):
    return [x.decode() for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or "")).encode().split()] + ["\n"]


@pytest.mark.parametrize("block", [300, 3_000_000])
def test_base_score_and_mixture_equal_plain_counts(spark, block):
    docs = corpus()
    rules = S.ScoreRules(block_tokens=block)
    got = S.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), rules=rules).collect()
    assert len(got) == len(docs)
    train = [tokens(t) for i, t in docs if fold(i) != 0]
    kept = [tokens(t) for i, t in docs if fold(i) not in (0, 9)]
    deleted = [tokens(t) for i, t in docs if fold(i) == 9]

    def counts(texts):
        one, two = Counter(x for t in texts for x in t), Counter((a, b) for t in texts for a, b in zip(["\r", *t], t))
        ahead = Counter(a for t in texts for a in ["\r", *t[:-1]])
        return one, two, ahead, sum(one.values()), len(one)
    one, two, ahead, n, v = counts(train)
    k1, k2, ka, kn, kv = counts(kept)
    events = Counter()
    for t in deleted:
        for a, b in zip(["\r", *t], t):
            h = ka[a]
            events[(int(math.log2(h)) + 1 if h else 0, k2[a, b] / max(h, 1), k1[b] / kn, 1 / (kv + 1))] += 1
    weights = {}
    for level in {e[0] for e in events}:
        w = np.full(3, 1 / 3)
        ps, ns = np.array([e[1:] for e in events if e[0] == level]), np.array([c for e, c in events.items() if e[0] == level])
        for _ in range(200):
            r = ps * w
            r /= r.sum(1, keepdims=True)
            w = (r * ns[:, None]).sum(0) / ns.sum()
        w[2] = max(w[2], 1e-4)
        weights[level] = w / w.sum()
    by = {}
    for i, t in docs:
        x = tokens(t)
        base = sum(math.log10((one[b] + 0.1) / (n + 0.1 * (v + 1))) for b in x)
        full = 0
        for a, b in zip(["\r", *x], x):
            h = ahead[a]
            level = int(math.log2(h)) + 1 if h else 0
            w = weights.get(level)
            full = None if w is None or full is None else full + math.log10(w[0] * two[a, b] / max(h, 1) + w[1] * one[b] / n + w[2] / (v + 1))
        by[i] = (fold(i) == 0, len(x), sum(one[b] > 0 for b in x), n, base, full)
    close = 0
    for r in got:
        held, length, known, total, base, full = by[r["doc"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, length, known, total)
        assert abs(r["base_score"] - base) < 1e-6
        if full is not None:
            close += 1
            assert abs(r["score"] - full) < 0.02 * abs(full) + 0.05
    assert close > 200
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 50


def test_weights_sum_to_one_and_prefer_what_predicts():
    cells = pd.DataFrame({"key": [(3 << 32) + (260 << 16) + 100, (3 << 32) + 0 + 100, (5 << 32) + 0 + 0], "n": [90, 10, 5]})
    w = S.mixture(cells, S.ScoreRules())
    assert w.shape == (65, 3) and np.allclose(w.sum(1), 1) and (w > -1e-12).all() and w[3, 0] > 0.8 and w[5, 2] > 0.99


def test_packed_numbers_come_back():
    for x in (np.array([], np.uint64), np.array([0, 1, 2 ** 64 - 1], np.uint64), np.sort(np.random.default_rng(0).integers(0, 2 ** 63, 1000).astype(np.uint64))):
        assert (S.unpacked(S.packed(x)) == x).all() and (S.unpacked_sorted(S.packed_sorted(x)) == x).all()


def test_nothing_to_learn_from_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    got = S.query(df).collect()
    assert [r["n_known"] for r in got] == [0, 0] and all(r["train_tokens"] == 0 and r["base_score"] == 0 and math.isfinite(r["score"]) for r in got)
    assert S.query(df.limit(0)).count() == 0
