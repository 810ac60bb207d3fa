"""Measures against plain loops."""

import random
import re
from collections import Counter

from larderline.llm import repetition as R

RULES = R.RepetitionRules()


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = [x for i, x in enumerate(lines) if x in lines[:i]]

    def grams(n):
        return [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]

    def inside(starts, n):
        return {p for i in starts for p in range(i, i + n)}
    c3 = Counter(grams(3))
    total = sum(map(len, w))
    out = {"n_words": len(w), "word_chars": total, "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(dup),
           "n_repeat_words": len(inside([i for i, g in enumerate(grams(3)) if c3[g] > 1], 3)), "dup_line_chars": sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x in dup)}
    top, repeated = {}, {}
    for n in (2, 3, 4):
        g = grams(n)
        if g:
            most = max(Counter(g).values())
            top[n] = 0.0
            if most > 1:
                size = max(sum(map(len, x)) for x, k in Counter(g).items() if k == most)
                best = {sum(len(w[p]) for p in inside([i for i, x in enumerate(g) if x == t], n)) / total for t, k in Counter(g).items() if k == most and sum(map(len, t)) == size}
                top[n] = best
    for n in range(5, 11):
        g = grams(n)
        repeated[n] = sum(len(w[p]) for p in inside([i for i, x in enumerate(g) if x in set(g[:i])], n)) / total if g else 0.0
    return out, top, repeated


def texts():
    rng = random.Random(11)
    out = [None, "", " \n\t\n ", "a", "a b", "É é x y z", "x" * 100000, "a b c " * 3000, "l\n\nl\n l\nm#*\r\nm#*\r"]
    for _ in range(60):
        vocabulary = ["".join(rng.choice("abcé#") for _ in range(rng.randint(1, 6))) for _ in range(rng.choice([3, 30, 300]))]
        w = [rng.choice(vocabulary) for _ in range(rng.randint(1, 150))]
        for _ in range(rng.randint(0, 3)):
            a = rng.randrange(len(w))
            w += w[a:a + rng.randint(1, 30)]
        out.append("".join(x + rng.choice([" ", " ", "\n", "\t"]) for x in w))
    return out


def test_measures_equal_plain_loops():
    for t in texts():
        if t and len(t) > 10000:
            continue
        m = R.measure(None if t is None else t.encode(), RULES)
        want, top, repeated = plain(t)
        assert {k: m[k] for k in want} == want
        for n, share in m["top"].items():
            assert any(abs(share - x) < 1e-9 for x in (top[n] if isinstance(top[n], set) else {top[n]}))
        assert all(abs(m["repeated"].get(n, 0.0) - x) < 1e-9 for n, x in repeated.items())


def test_query_over_odd_rows(spark):
    rows = [(i, t, 7) for i, t in enumerate(texts())] + [(None, "a b", 7), (3, "a", 7)]
    got = R.query(spark.createDataFrame(rows, "doc_id long, text string, n_words int")).collect()
    assert len(got) == len(rows)
    for r in got:
        t = next(x for i, x, _ in rows if i == r["doc_id"] and plain(x)[0]["n_words"] == r["n_words"])
        n, rep = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n) and r["kept"] == (not r["base_failed"] and r["broken"] == "") and (r["word_chars"] == plain(t)[0]["word_chars"])
    assert R.query(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_many_words_stay_exact():
    import numpy as np
    ids = np.arange(3_000_000)
    assert len(np.unique(R.exact_windows(ids, 3))) == len(ids) - 2


def test_clean_and_repetitive_texts():
    rng = random.Random(1)
    clean = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400))
    loop = clean + " " + " ".join(["this part comes again and again and again in it"] * 30)
    for text, good in ((clean, True), (loop, False)):
        m = R.measure(text.encode(), RULES)
        assert (not R.base_failed(m, RULES) and not R.repetitive(m, RULES)) == good
