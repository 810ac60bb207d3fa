"""Fingerprints and components against plain loops."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.llm import simhash
from larderline.llm.common import components

SCHEMA = "doc_id long, text string"


def plain_print(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).encode().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    fs = list(root)
    for i, a in enumerate(fs):
        for b in fs[i + 1:]:
            if bin(a ^ b).count("1") <= 3:
                root[find(a)] = find(b)
    return {f: find(f) for f in fs}


def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    out = [None, "", " \t", "One", "one two", "ONE two", "É x y z", "a b c d", "a b\tc\n d"]
    for _ in range(30):
        base = [word() for _ in range(rng.randint(40, 400))]
        out.append(" ".join(base))
        for _ in range(4):
            near = list(base)
            near[rng.randrange(len(near))] = word()
            out.append(" ".join(near))
    return out


def test_query_equals_brute_force(spark):
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts())] + [(4, texts()[1]), (None, "one two")]
    got = simhash.query(spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit("x"))).collect()
    assert len(got) == len(rows)
    want = [(d, plain_print(t)) for d, t in rows]
    root = plain_components({f for _, f in want})
    least = {}
    for d, f in want:
        if d is not None:
            least[root[f]] = min(least.get(root[f], d), d)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(((d, f"{f:016x}", least[root[f]]) for d, f in want), key=key)
    assert len({r[2] for r in got}) < len(rows) - 60


@pytest.mark.parametrize("size", [40, 3000])
def test_dense_group_of_prints_is_one_component_with_few_links(spark, size):
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 2 ** 63))
    fps = {centre}
    while len(fps) < size:
        f = centre
        for b in rng.choice(64, rng.integers(1, 3), replace=False):
            f ^= 1 << int(b)
        fps.add(f)
        if len(fps) == 1 + 64 + 2016:
            break
    far = [int(x) for x in rng.integers(0, 2 ** 63, 300)]
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in [*fps, *far]]
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    pairs = found.collect()
    assert len(pairs) < 70 * len(fps) and all(bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 3 for a, b in pairs)
    roots = {r["node"]: r["root"] for r in components(found).collect()}
    assert len({roots.get(f, f) for f in signed[:len(fps)]}) == 1 and len(roots) == len(fps) - 1


def test_every_distance_up_to_three_is_found(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
            b ^= 1 << k
        pairs.append((a, b))
    sign = lambda f: f - 2 ** 64 if f >= 2 ** 63 else f
    got = {tuple(sorted(r)) for r in simhash.links(spark.createDataFrame([(sign(f),) for p in pairs for f in p], "fp long")).collect()}
    assert got == {tuple(sorted(map(sign, p))) for p in pairs if bin(p[0] ^ p[1]).count("1") <= 3}


def test_long_chain_and_empty(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(500)] + [(1000, 900), (900, 1000), (7, 7)], "a long, b long")
    assert {r["root"] for r in components(edges).collect() if r["node"] <= 500} == {0}
    assert {tuple(r) for r in components(edges).where("node > 600").collect()} == {(1000, 900)}
    assert simhash.query(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "a b c d e", 1), (2, "A b c d e", 2), (9, "f g h i", 3), (None, "a b c d e", 4), (2, "A b c d e", 2), (9, "a b c d e", 6), (None, "z", 7), (None, "z", 7), (None, "y", 8)]
    kept = simhash.drop_copies(spark.createDataFrame(rows, T.StructType.fromDDL("doc_id long, text string, _k1 int")))
    assert sorted(r["_k1"] for r in kept.collect()) == [2, 3, 7, 8] and kept.columns == ["doc_id", "text", "_k1"]
