"""Segments against their definition, the law's scale, and accuracy on texts that were held out."""

import random

import numpy as np
from pyspark.sql import functions as F

from larderline.llm import toxicity as X


def plain_segments(s, a, b):
    best = max(((sum(s[i:j]), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    return plain_segments(s, a, i) + [(i, j, best[0])] + plain_segments(s, j, b)


def test_segments_are_the_maximal_ones():
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.gauss(-0.2, 1) for _ in range(rng.randint(0, 25))]
        got = X.segments(np.array(s))
        want = plain_segments(s, 0, len(s))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([x for *_, x in got], [x for *_, x in want])
    many = np.where(np.arange(200_001) % 2 == 0, 1.0, -0.5)
    assert X.segments(many) == [(0, 200_001, 100_001 - 50_000.0)]
    assert len(X.segments(np.where(np.arange(200_001) % 2 == 0, 1.0, -1.5))) == 100_001


def test_scale_is_the_root():
    scores, share = np.array([-1.0, 2.0]), np.array([0.9, 0.1])
    lam = X.scale_of(scores, share)
    assert lam > 0 and abs((share * np.exp(lam * scores)).sum() - 1) < 1e-6
    assert X.scale_of(np.array([-1.0]), np.array([1.0])) == 1.0


def corpus(n=900):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeiounrstlm") for _ in range(rng.randint(2, 7)))
    docs, labels = [], []
    for i in range(n):
        w, toxic = [word() for _ in range(rng.randint(20, 300))], int(rng.random() < 0.2)
        for _ in range(rng.randint(3, 7) * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(["VILEWORD,", "grobian" + word(), "nasty."]))
        docs.append((i, " ".join(w)))
        labels.append((i, toxic))
    return docs, labels


def test_held_out_documents_and_passages(spark):
    docs, labels = corpus()
    odd = [(5000, None), (5001, ""), (5002, "..."), (None, "nasty"), (0, docs[0][1]), (5003, "x " * 60000 + "vileword nasty vileword nasty")]
    lab = spark.createDataFrame(labels + [(1, 0), (7777, 1), (None, 1), (5, None)], "doc_id long, toxic int").withColumn("text", F.lit("z"))
    df = spark.createDataFrame(docs + odd, "doc_id long, text string").withColumn("score", F.lit("s"))
    got = X.query(df, lab).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    truth = dict(labels)
    held = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    assert len(held) > 120 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    by = {r["doc_id"]: r for r in got}
    assert by[5003]["passages"] and all(p["start"] >= 60000 for p in by[5003]["passages"])
    for i, t in docs:
        for p in by[i]["passages"]:
            assert {"vileword", "nasty"} & set(X.tokens(t.encode().lower())[p["start"]:p["end"]] and [w.decode() for w in X.tokens(t.encode())[p["start"]:p["end"]]]) or "grobian" in " ".join(w.decode() for w in X.tokens(t.encode())[p["start"]:p["end"]])
    assert by[5000]["score"] == by[5001]["score"] == by[5002]["score"] < 0.5


def test_no_labels_and_no_documents(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["predicted"] for r in X.query(df, none).collect()] == [0]
    assert [r["predicted"] for r in X.query(df, spark.createDataFrame([(1, 0)], "doc_id long, toxic int")).collect()] == [0]
    assert X.query(df.limit(0), none).count() == 0


def test_bound_of_the_sample_leaves_the_threshold(spark):
    rng = random.Random(4)
    rows = []
    for i in range(4400):
        toxic = i % 11 == 0
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(15, 40))]
        for _ in range(rng.choice([0, 1, 2, 3, 4]) if toxic else rng.choice([0] * 12 + [1, 2])):
            words.insert(rng.randint(0, len(words)), f"foul{rng.randint(0, 3)}")
        rows.append((i, " ".join(words), int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", "toxic")
    whole = X.train_model(docs, labels)
    small = X.train_model(docs, labels, rules=X.ToxicityRules(sample_rows=300))
    assert abs(small.offset - whole.offset) < 0.7, (small.offset, whole.offset)


def test_link_weighs_classes_as_in_the_whole_table():
    rng = np.random.default_rng(3)
    toxic = (np.arange(40_000) % 20 == 0).astype(int)
    normal = rng.normal(0, 1, len(toxic)) + 1.5 * toxic
    chosen = np.concatenate([np.flatnonzero(toxic == k)[:1500] for k in (0, 1)])
    whole, part = X.link(normal, toxic), X.link(normal[chosen], toxic[chosen], np.array([38_000 / 1500, 2000 / 1500]))
    assert np.abs(np.subtract(whole, part)).max() < 0.3 and X.link(normal[chosen], toxic[chosen])[1] > whole[1] + 2
