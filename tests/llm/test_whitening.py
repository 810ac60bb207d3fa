"""Whitening against exact whole-number sums and a plain eigen-decomposition."""

import math
from fractions import Fraction

import numpy as np
import pytest

from larderline.llm import whitening
from larderline.llm.whitening import WhitenRules

SCHEMA = "vec_id long, embedding array<float>, x string, dim int"


def brute(rows, rules=WhitenRules()):
    """{vec_id: (deviation, whitened by component)}, n, explained, from all rows at once."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    xs = [[math.floor(Fraction(float(np.float32(c))) * rules.scale) + rules.shift for c in v] for _, v in good]
    fit = xs if rules.weights == "counts" else [list(t) for t in {tuple(x) for x in xs}]
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    centred = np.array([[float(Fraction(x[k]) - Fraction(s[k], n)) for k in range(d)] for x in fit])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    out = []
    for (i, _), x in zip(good, xs):
        y = np.array([float(Fraction(x[k]) - Fraction(s[k], n)) for k in range(d)])
        out.append((i, sum((n * x[k] - s[k]) ** 2 for k in range(d)), y @ u[:, :rules.components] / np.sqrt(e[:rules.components])))
    return out, n, e / e.sum()


def some(n, d, seed=5):
    rng = np.random.default_rng(seed)
    v = (rng.normal(size=(n, d)) * np.linspace(0.3, 0.02, d) + rng.normal(size=d)).astype(np.float32)
    return [(k, [float(c) for c in row]) for k, row in enumerate(v)]


@pytest.mark.parametrize("rules", [WhitenRules(), WhitenRules(weights="one"), WhitenRules(hot=2, salts=3)])
def test_equals_brute_force(spark, rules):
    rows = some(300, 12)
    rows += [(1000 + k, rows[7][1]) for k in range(200)] + [(2000, None), (2001, [float("nan")] * 12), (2002, [None] * 12), (2003, [float("inf")] + [0.0] * 11)]
    df = spark.createDataFrame([(i, v, "same", 3) for i, v in rows], SCHEMA).repartition(7)
    got = whitening.query(df, rules).collect()
    want, n, explained = brute(rows, rules)
    assert len(got) == 8 * len(want) and {r["n"] for r in got} == {n}
    by = {(r["vec_id"], r["component"]): r for r in got}
    side = [np.sign(by[0, k + 1]["whitened"] * want[0][2][k]) for k in range(8)]
    for i, deviation, z in want:
        for k in range(8):
            r = by[i, k + 1]
            assert r["deviation"] == deviation
            assert r["whitened"] * side[k] == pytest.approx(z[k], abs=1e-9)
            assert r["explained"] == pytest.approx(explained[k], rel=1e-9)
            assert 0 <= r["identity_error"] < 1e-9


def test_large_entries_stay_exact(spark):
    rows = [(0, [1e9, -1e9]), (1, [-1e9, 3e9]), (2, [0.5, 0.25]), (3, [7e5, 40.0])]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame([(i, v, "", 0) for i, v in rows], SCHEMA)).collect()}
    assert {i: int(v) for i, v in got.items()} == {i: d for i, d, _ in brute(rows)[0]}
    long = {r["vec_id"]: r["deviation"] for r in whitening.query(spark.createDataFrame([(i, v, "", 0) for i, v in rows], SCHEMA)).collect()}
    assert long[0] is None  # beyond a long


def test_odd_rows(spark):
    a, b = [0.1, 0.2, 0.3], [0.3, -0.1, 0.0]
    rows = [(None, a), (None, a), (1, b), (1, b), (2, []), (3, [0.1, 0.2]), (4, None), (5, [0.5, 0.5, 0.1])]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], SCHEMA)
    got = whitening.query(df).collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in got) == sorted((str(i), k) for i in (None, None, 1, 1, 5) for k in (1, 2, 3))
    assert {r["n"] for r in got} == {5}
    assert all((r["whitened"] is None) == (r["component"] == 3) for r in got)  # three vectors spread over a plane


def test_no_spread_and_no_rows(spark):
    alike = whitening.query(spark.createDataFrame([(k, [0.5, 0.5], "", 0) for k in range(3)], SCHEMA)).collect()
    assert len(alike) == 6 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in alike)
    for rows in ([], [(1, None, "", 0)], [(1, [], "", 0)]):
        empty = whitening.query(spark.createDataFrame(rows, SCHEMA))
        assert empty.collect() == [] and dict(empty.dtypes)["deviation"] == "bigint"


def test_wrong_weights(spark):
    with pytest.raises(ValueError):
        whitening.query(spark.createDataFrame([], SCHEMA), WhitenRules(weights="two"))
