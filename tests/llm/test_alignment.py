"""Alignment against plain loops over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from larderline.llm import alignment
from larderline.llm.alignment import AlignRules, Rows, Tokenizers

public_tokenizers = pytest.importorskip("public_tokenizers")
pytest.importorskip("sentencepiece")
RULES = AlignRules(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = [None, "", " ", "  ", "\n", "a", "a ", "a  ", " a", "one two", "one  two\n\n three \t four  ", "a▁b and more", "naïve façade 東京タワー 🤖 ①", "<s> and <|endoftext|> are text",
         "x" * 300, "\x00 \x1c \x85   z", "if (x == 0) {\n\t\treturn None;\n    }\r\n", "it's they'll", "é á", "one two", "12345 67.8"]


def tokens(text):
    """[(id, begin, end)] of A and of B over the bytes of the text behind a space; None without tokens."""
    t = Tokenizers.of(RULES)
    if not text:
        return None
    out, data = [], (" " + text).encode()
    for ids, bytes_of in ((t.a.encode(" " + text, add_special_tokens=False).ids, t.bytes_a), (t.b.encode(text), t.bytes_b)):
        if b"".join(bytes_of[k] for k in ids) != data:
            return None
        at, spans = 0, []
        for k in ids:
            spans.append((k, at, at + len(bytes_of[k])))
            at += len(bytes_of[k])
        out.append(spans)
    return out


def overlaps(a, b):
    return [(i, j, x[0], y[0], min(x[2], y[2]) - max(x[1], y[1])) for i, x in enumerate(a) for j, y in enumerate(b) if max(x[1], y[1]) < min(x[2], y[2])]


def brute(texts):
    told = [tokens(t) for t in texts]
    links = [overlaps(*t) if t else [] for t in told]
    count = Counter((x[2], x[3]) for one in links for x in one)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for t, mine in zip(told, links):
        if not t:
            out.append((0, 0, 0, 0, 0, 0, "", 0))
            continue
        ends = sorted({e for _, _, e in t[0]} & {e for _, _, e in t[1]})
        groups = [[[str(k) for k, _, e in side if begin < e <= end] for side in t] for begin, end in zip([0, *ends], ends)]
        digest = hashlib.sha256(";".join("|".join(map(",".join, g)) for g in groups).encode()).hexdigest()
        out.append((len(t[0]), len(t[1]), len(ends), len(mine), sum(count[x[2:4]] == most[x[3]] for x in mine), sum(count[x[2:4]] for x in mine), digest, sum(len(g[0]) * len(g[1]) for g in groups)))
    return out


def some_texts():
    rng = random.Random(4)
    words = ["the", "token", "Überweisung", "x1", "—", "isn't", "\n", "\t", " ", "  ", "東", "running", "a.b", "▁", "''", "é"]
    return TEXTS + ["".join(rng.choice(words) + rng.choice(("", " ", " ", "  ")) for _ in range(rng.randrange(1, 40))) for _ in range(150)]


@pytest.mark.parametrize("rules", [RULES, AlignRules(RULES.byte_level, RULES.pieces, block_segments=20, expansion=7)])
def test_equals_plain_loops(spark, rules):
    texts = some_texts()
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in enumerate(texts)] + [(None, "one two", 1, "x")] * 2, "doc_id long, text string, block int, keys string").repartition(3)
    got = alignment.query(df, rules).collect()
    assert got[0].__fields__ == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]
    assert sorted((r[0] is None, r[0] or 0, tuple(r)[1:]) for r in got) == sorted((i is None, i or 0, w) for i, w in zip([*range(len(texts)), None, None], brute(texts + ["one two"] * 2)))


def test_links_of_tokens(spark):
    texts = TEXTS + ["unbelievable interoperability of tokens"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = Counter(map(tuple, alignment.token_links(df, RULES).collect()))
    assert got == Counter((k, *x) for k, t in enumerate(texts) if (told := tokens(t)) for x in overlaps(*told))
    groups = alignment.token_links(df, RULES, shared=True).groupBy("doc").count().collect()
    assert {r["doc"]: r["count"] for r in groups} == {k: w[7] for k, w in enumerate(brute(texts)) if w[7]}


def test_products_equal_dense_ones():
    rng = np.random.default_rng(2)
    for expansion in (1, 5, 1000):
        dense = [rng.integers(0, 3, shape) * (rng.random(shape) < 0.3) for shape in ((7, 9), (9, 6))]
        a, b = (Rows(np.concatenate(([0], np.cumsum((m > 0).sum(1)))), np.nonzero(m)[1], m[m > 0], m.shape[1]) for m in dense)
        out = np.zeros((7, 6), int)
        for i, j, v in a.products(b, expansion):
            out[i, j] = v
        assert (out == dense[0] @ dense[1]).all()
        t = a.transposed()
        assert [t.column[t.start[k]:t.start[k + 1]].tolist() for k in range(9)] == [np.flatnonzero(dense[0][:, k]).tolist() for k in range(9)]


def test_segments_give_what_whole_texts_give():
    t = Tokenizers.of(RULES)
    assert t.cuts and all(t.alike(x) for x in some_texts() if x and "▁" not in x)  # with that sign, a text has no tokens anyhow


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.query(empty, RULES).collect() == [] and alignment.token_links(empty, RULES).collect() == []
    none = alignment.query(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), RULES).collect()
    assert [tuple(r)[1:] for r in none] == [(0, 0, 0, 0, 0, 0, "", 0)] * 2
