"""Tiling against a plain greedy search, and the scan and join against all pairs."""

import random

import numpy as np
import regex
from pyspark.sql import functions as F

from larderline.llm import decontaminate as D

RULES = D.TilingRules()


def plain_tiles(d, t, low):
    free_d, free_t, found = [True] * len(d), [True] * len(t), []
    while True:
        best = (0, 0, 0)
        for j in range(len(t)):
            for i in range(len(d)):
                k = 0
                while i + k < len(d) and j + k < len(t) and free_d[i + k] and free_t[j + k] and d[i + k] == t[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, j, i)
        k, j, i = best
        if k < low:
            return found
        found.append((i, j, k))
        free_d[i:i + k] = [False] * k
        free_t[j:j + k] = [False] * k


def test_rolling_hashes_tell_windows_apart():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 5, 300).astype(np.uint64)
    for n in (1, 2, 3, 5, 8, 13, 20, 31):
        h = D.rolling(a, n)
        windows = [tuple(a[i:i + n].tolist()) for i in range(len(a) - n + 1)]
        assert len(h) == len(windows) and len(set(h.tolist())) == len(set(windows))
        assert all((h[i] == h[j]) == (windows[i] == windows[j]) for i, j in rng.integers(0, len(h), (500, 2)))
    assert len(D.rolling(a[:3], 4)) == 0


def test_tiles_cover_as_a_plain_greedy_search_does():
    rng = random.Random(2)
    for _ in range(120):
        t = [rng.randint(0, 30) for _ in range(rng.randint(3, 45))]
        d = [rng.randint(0, 30) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 4)):
            a = rng.randint(0, len(t) - 1)
            d[rng.randint(0, len(d)):0] = t[a:a + rng.randint(3, 30)]
        got = D.tiles(np.array(d, np.uint64), np.array(t, np.uint64), RULES)
        want = plain_tiles(d, t, 5)
        assert all(d[i:i + k] == t[j:j + k] and k >= 5 for i, j, k in got)
        assert len({p for i, _, k in got for p in range(i, i + k)}) == sum(k for _, _, k in got) == len({p for _, j, k in got for p in range(j, j + k)})
        assert sorted(k for *_, k in got)[::-1][:1] == sorted(k for *_, k in want)[::-1][:1]
        assert abs(sum(k for *_, k in got) - sum(k for *_, k in want)) <= 4


def test_query_equals_all_pairs(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeéü") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(5, 40)))) for i in range(30)] + [(30, None), (31, ""), (32, "a b c"), (None, " ".join(word() for _ in range(20)))]
    docs = []
    for i in range(120):
        w = [word() for _ in range(rng.randint(0, 300))]
        if i % 3 == 0:
            item = (rng.choice(items[:30])[1]).split()
            if i % 2:       # parts in another order, in capitals, with signs
                cut = rng.randint(1, len(item) - 1)
                item = [x.upper() for x in item[cut:] + item[:cut]]
            if i % 4 == 0:  # a part only
                item = item[:rng.randint(1, len(item))]
            at = rng.randint(0, len(w))
            w[at:at] = ["(" + x + ")," for x in item]
        docs.append((i, " ".join(w)))
    docs += [(500, None), (501, ""), (None, items[3][1]), (502, items[-1][1]), (0, docs[0][1]), (7, items[5][1]), (503, "word " * 20000 + items[6][1])]
    D_, I = spark.createDataFrame(docs, "doc_id long, text string").withColumn("seeds", F.lit(1)), spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1))
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in D.query(D_, I).collect()}
    tokens = lambda x: regex.findall(r"[\p{L}\p{N}]+", (x or "").lower())
    want = {}
    for d, x in docs:
        for i, y in items:
            a, b = tokens(x), tokens(y)
            if len(b) >= 5:
                near = plain_tiles(a if len(a) < 2000 else a[-200:], b, 5)
                share = sum(k for *_, k in near) / len(b)
                if share >= 0.5:
                    want[d, i] = max(share, want.get((d, i), 0))
    assert set(got) == set(want) and len(got) > 25 and all(abs(got[k] - want[k]) < 0.2 for k in got)
    assert D.query(D_.limit(0), I).count() == 0 and D.query(D_, I.limit(0)).count() == 0
    left = D.drop_contaminated(D_, I)
    assert left.columns == D_.columns and {r["doc_id"] for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_many_items_of_one_document_and_one_item_in_many(spark):
    rng = random.Random(6)
    items = [(i, " ".join(str(rng.randint(0, 10 ** 6)) for _ in range(12))) for i in range(40)]
    docs = [(1, "\n".join(t for _, t in items))] + [(10 + k, f"x{k} " + items[0][1] + f" y{k}") for k in range(200)]
    got = D.query(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, i) for i, _ in items} | {(10 + k, 0) for k in range(200)}


def test_head_of_a_match_that_a_tile_cuts_is_searched_again():
    t = list(range(24))
    d = t[7:16] + [90, 91] + t[:7] + [7] + [92]
    got = D.tiles(np.array(d, np.uint64), np.array(t, np.uint64), RULES)
    assert sorted(got) == [(0, 7, 9), (11, 0, 7)]


def test_tiles_are_those_of_the_plain_greedy_search():
    rng = random.Random(7)
    for _ in range(200):
        t = [rng.randint(0, rng.choice([3, 30, 1000])) for _ in range(rng.randint(5, 60))]
        d = [rng.randint(0, 30) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 6)):
            a = rng.randint(0, len(t) - 1)
            at = rng.randint(0, len(d))
            d[at:at] = t[a:a + rng.randint(3, 40)]
        got = D.tiles(np.array(d, np.uint64), np.array(t, np.uint64), RULES)
        assert sorted(got) == sorted(plain_tiles(d, t, 5))


def test_repeated_tokens_are_linear():
    import time
    rng = random.Random(3)
    for d, t in (([7] * 60, [7] * 13), ([7, 8] * 30, [8, 7] * 9), ([7] * 30 + [8] + [7] * 20, [7] * 12 + [9] + [7] * 6), ([rng.randint(0, 1) for _ in range(80)], [rng.randint(0, 1) for _ in range(30)])):
        assert sorted(D.tiles(np.array(d, np.uint64), np.array(t, np.uint64), RULES)) == sorted(plain_tiles(d, t, 5))
    start = time.perf_counter()
    got = D.tiles(np.full(20_000, 7, np.uint64), np.full(200, 7, np.uint64), RULES)
    assert got == [(0, 0, 200)] and time.perf_counter() - start < 1
    start = time.perf_counter()
    got = D.tiles(np.tile(np.arange(2, dtype=np.uint64), 10_000), np.tile(np.arange(3, dtype=np.uint64), 70), RULES)
    assert time.perf_counter() - start < 1
