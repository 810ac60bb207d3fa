"""One document of each group of near copies, against all pairs."""

import random
import time
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest

from larderline.llm import near_words
from larderline.llm.near_words import CopyRules

SCHEMA = "doc_id long, text string, t1 long, root string"


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[k:k + n]) for k in range(max(len(w) - n + 1, 1))}


def similar(a, b):
    return len(a & b) / len(a | b)


def near_pairs(texts, least=0.8):
    """Pairs of places of texts at a similarity of ``least`` or more, by an exact prefix filter."""
    sets = [shingles(t) for t in texts]
    count = {}
    for s in sets:
        for x in s:
            count[x] = count.get(x, 0) + 1
    met, out = {}, set()
    for k, s in enumerate(sets):
        order = sorted(s, key=lambda x: (count[x], x))
        for x in order[:len(order) - -(-int(least * 1000) * len(order) // 1000) + 1]:
            out |= {(j, k) for j in met.get(x, ()) if similar(sets[j], s) >= least}
            met.setdefault(x, []).append(k)
    return out, sets


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(3000)]
    line = lambda n: rng.choices(vocabulary, k=n)
    base = [line(rng.randint(30, 300)) for _ in range(120)]
    texts = [" ".join(w) for w in base]
    for k in range(260):   # a third of all rows are copies of one
        w = list(base[0] if k % 2 else rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(w) // 60))):
            at = rng.randrange(len(w))
            w[at:at + rng.randint(0, 2)] = line(1)
        texts.append((" " if k % 5 else "\n").join(w))
    return texts + [None, "", " \n", "one two", "one  Two", "one two three", texts[5].upper()]


@pytest.mark.parametrize("rules", [CopyRules(), CopyRules(rounds=0), CopyRules(rounds=1)])
def test_what_stays_and_what_goes(spark, rules):
    texts = corpus()
    rows = [(k, t, k, "x") for k, t in enumerate(texts)]
    rng = random.Random(1)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows + rows[:30] + [(None, "alone of all", 1, None)], SCHEMA).repartition(5)
    got = near_words.drop_near_copies(df, rules=rules)
    assert got.columns == df.columns
    kept = {r["doc_id"] for r in got.collect()}
    assert got.count() == len(kept) and None in kept
    pairs, sets = near_pairs(texts)
    left = [(a, b) for a, b in pairs if a in kept and b in kept]
    assert len(left) <= 0.02 * len(pairs) and len(pairs) > 5000
    stay = [sets[k] for k in kept if k is not None]
    assert all(any(similar(s, other) >= 0.8 for other in stay) for k, s in enumerate(sets) if k not in kept)
    partners = {k for p in pairs for k in p}
    assert all(k in kept for k in range(len(texts)) if k not in partners)   # without a near copy, a text stays


def test_rounds_do_not_change_what_stays(spark):
    df = spark.createDataFrame([(k, t, k, "x") for k, t in enumerate(corpus(8))], SCHEMA)
    kept = [sorted(r["doc_id"] for r in near_words.drop_near_copies(df, rules=CopyRules(rounds=n)).collect()) for n in (0, 2)]
    assert kept[0] == kept[1]


def test_no_rows_and_one_text(spark):
    assert near_words.drop_near_copies(spark.createDataFrame([], SCHEMA)).collect() == []
    same = spark.createDataFrame([(k, "the same text of six words", 0, "") for k in (5, 3, None, 9)], SCHEMA)
    assert [r["doc_id"] for r in near_words.drop_near_copies(same).collect()] == [3]


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="driver tables absent")
def test_recall_on_the_driver_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    texts = {}
    for r in docs.orderBy("doc_id").collect():
        words = b" ".join((r["text"] or "").encode().lower().split())
        texts.setdefault(words, (r["doc_id"], r["text"]))
    ids, whole = zip(*texts.values())
    kept = {r["doc_id"] for r in near_words.drop_near_copies(docs).collect()}
    pairs, sets = near_pairs(whole)
    found = sum(ids[a] not in kept or ids[b] not in kept for a, b in pairs)
    assert len(pairs) >= 40 and found >= 0.9 * len(pairs)
    partners = {k for p in pairs for k in p}
    assert all(ids[k] in kept for k in range(len(ids)) if k not in partners)


def test_many_unlike_texts_of_a_region_take_little_time():
    rng = np.random.default_rng(4)
    sets = [np.sort(rng.integers(-2**62, 2**62, 300)) for _ in range(2000)]
    sets += [np.union1d(sets[k][30 * (k % 3):], rng.integers(-2**62, 2**62, 10)) for k in range(0, 2000, 40)] + [sets[7], sets[0][:0], sets[0][:0]]
    began, held = time.process_time(), near_words.Held(CopyRules())
    got = [held.takes(s) for s in sets]
    assert time.process_time() - began < 5   # each with all that stay: 25 s
    want, stay = [], []
    for s in map(lambda x: set(x.tolist()), sets[:150] + sets[2000:]):
        want.append(not any(len(s & t) >= 0.8 * len(s | t) - 1e-9 for t in stay))
        stay += [s] if want[-1] else []
    held = near_words.Held(CopyRules())
    assert [held.takes(s) for s in sets[:150] + sets[2000:]] == want
    assert got[:2000] == [True] * 2000 and 0 < sum(got[2000:]) < 40 and got[-2:] == [True, False]


def test_a_crowded_cell_is_walked_as_by_loops():
    rng = np.random.default_rng(5)

    def turned(x, k):
        for _ in range(k):
            x = x ^ (np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64))
        return x

    def cell(n):
        p, c = turned(np.repeat(rng.integers(0, 2**63, 1, dtype=np.uint64), n), 4), rng.integers(0, 2**63, n, dtype=np.uint64)
        c[n // 2:] = turned(c[rng.integers(0, n // 3, n - n // 2)], 8)
        return p, c, rng.random(n) < 0.5

    p, c, home = cell(300)
    open_, want = set(range(300)), []
    for seed in np.flatnonzero(home).tolist():
        queue = [seed] if seed in open_ else []
        open_ -= set(queue)
        for at in queue:
            found = [k for k in sorted(open_) if near_words.close(p, c, np.array([at]), np.array([k]), CopyRules())[0]]
            open_ -= set(found)
            want += [(at, k) for k in found]
            queue += found
    assert list(zip(*near_words.walked(p, c, home, CopyRules()))) == want and len(want) > 50
    p, c, home = cell(30000)
    began = time.process_time()
    near_words.walked(p, c, home, CopyRules())
    spent = time.process_time() - began
    began = time.process_time()
    for at in range(0, 30000, 100):   # one look in a hundred, at all fingerprints anew
        near_words.close(p, c, at, np.arange(30000), CopyRules())
    assert spent < 20 * (time.process_time() - began)
