"""Lines of many sites against plain loops; only native operators in the plan."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from larderline.llm import line_dedup as D

SCHEMA = "doc_id long, text string, source string, n_lines string"


def plain(rows, least, keep_first=True):
    sites, first = defaultdict(set), {}
    for i, t, s, _ in rows:
        for pos, line in enumerate((t or "").split("\n") if t is not None else []):
            if line.strip(" \t\n\r\x0b\x0c"):
                k = line.strip(" \t\n\r\x0b\x0c")
                sites[k].add(s or "")
                at = ((i is not None, i or 0), pos)
                first[k] = min(first.get(k, at), at)
    out = []
    for i, t, s, x in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        keep = []
        for pos, line in enumerate(t.split("\n")):
            k = line.strip(" \t\n\r\x0b\x0c")
            blank = not line.strip(" \t\n\r\x0b\x0c")
            if blank or len(sites[k]) < least or (keep_first and first[k] == ((i is not None, i or 0), pos)):
                keep.append(line)
        n = len(t.split("\n"))
        out.append((i, "\n".join(keep), n, n - len(keep)))
    return out


def fixture():
    rng = random.Random(5)
    common = [f"common line {k}" for k in range(40)]
    rows = []
    for i in range(400):
        lines = [rng.choice([f"own {i} {k}", rng.choice(common), rng.choice(common[:3]), "", "  ", "\t", f" {common[0]} ", f"{common[1]}\r", f"\t{common[2]}\x0c"]) for k in range(rng.randint(0, 12))]
        rows.append((i, "\n".join(lines), rng.choice([None, *(f"s{k}" for k in range(rng.choice([2, 12])))]), "x"))
    return rows + [(1000, None, "s1", "x"), (1001, "", None, "x"), (None, "common line 1\nown", "s9", "x"), (7, rows[7][1], rows[7][2], "x"), (1002, "\n".join(["common line 0"] * 3000 + ["end"]), "s2", "x")]


def key(r):
    return (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", *r[2:])


def test_equals_plain_loops_at_several_thresholds(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for least, first in ((2, True), (5, True), (9, False)):
        got = D.remove_spread_lines(df, rules=D.LineRules(min_sites=least, keep_first=first), names=("a", "b")).select("doc_id", "text", "a", "b").collect()
        assert sorted(map(tuple, got), key=key) == sorted(plain(rows, least, first), key=key)


def test_sure_lines_skip_the_exact_count_and_agree_with_it(spark):
    rows = [(i, f"everywhere\nsome {i % 40}\nown {i}", f"s{i % 97}", "x") for i in range(3000)]
    got = D.spread_lines(D.lines_of(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "source"), D.LineRules(min_sites=60)).count()
    sites = defaultdict(set)
    for _, t, s, _ in rows:
        for line in t.split("\n"):
            sites[line].add(s)
    assert got == sum(len(x) >= 60 for x in sites.values())


def test_columns_plan_and_empty_table(spark):
    df = spark.createDataFrame(fixture(), SCHEMA).withColumn("_gone", F.lit(1)).withColumn("_d", F.lit(2))
    out = D.remove_spread_lines(df)
    assert out.columns == ["doc_id", "text", "source", "_gone", "_d", "n_lines", "n_removed"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert D.remove_spread_lines(df.limit(0)).count() == 0


def test_a_line_with_carriage_return_equals_the_line_without(spark):
    rows = [(i, "shared line" + "\r" * (i % 2) + f"\nown {i}", f"s{i}", "x") for i in range(8)]
    got = {r["doc_id"]: r["text"] for r in D.remove_spread_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: "shared line\nown 0" if i == 0 else f"own {i}" for i in range(8)}
