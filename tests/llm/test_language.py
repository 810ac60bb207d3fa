"""Language identification: features of whole texts, codes, held-out accuracy, odd rows."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from larderline.llm import language as L

ALPHABETS = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "ijklmnop", "dd": "mnopqrst", "ee": "qrstuvwx", "ff": "éüßñaeio", "gg": "αβγδεζηθ"}


def text_in(rng, lang, n):
    return " ".join("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 8))).capitalize() for _ in range(n)) + "."


def test_pieces_give_the_features_of_the_whole_text():
    rng = random.Random(1)
    rules = L.LanguageRules()
    for _ in range(40):
        t = "".join(rng.choice("aB é1,\n") for _ in range(rng.randint(1, 300)))
        whole = Counter(np.concatenate(list(L.features(t, rules))).tolist())
        small = L.LanguageRules(piece=rng.randint(1, 40))
        assert Counter(np.concatenate(list(L.features(t, small))).tolist()) == whole


def test_codewords_differ():
    for n in (1, 2, 3, 4, 5, 6, 20, 150):
        code = L.codewords(n, L.LanguageRules())
        apart = (code[:, None, :] != code[None, :, :]).sum(2)[~np.eye(n, dtype=bool)]
        assert n == 1 or apart.min() >= max(1, code.shape[1] // 4)


def test_held_out_accuracy_with_few_and_many_languages(spark):
    rng = random.Random(2)
    for langs in (["aa", "bb", "cc", "ff"], list(ALPHABETS)):
        rows = [(i, text_in(rng, lang := rng.choice(langs), rng.randint(3, 60)), lang) for i in range(600)]
        got = {r["doc_id"]: r for r in L.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
        held = [(got[i]["lang_pred"], lang) for i, _, lang in rows if got[i]["held_out"]]
        assert len(held) > 100 and np.mean([a == b for a, b in held]) > 0.97
        assert all(0 <= r["score"] <= 1 for r in got.values())


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, text_in(rng, lang := rng.choice(["aa", "dd"]), 30), lang) for i in range(200)]
    odd = [(900, None, "aa"), (901, "", None), (902, "12 !? \n 34", "dd"), (903, "日" , None), (None, rows[0][1], rows[0][2]), (0, rows[0][1], rows[0][2]), (904, text_in(rng, "dd", 200_000), None), (905, "İ", None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = L.predict(df).collect()
    assert len(got) == 208
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3 and all(by[i]["score"] == 0 for i in (900, 901, 902))
    assert by[903]["ambiguous"] and by[904]["lang_pred"] == "dd" and by[None]["lang_pred"] == rows[0][2]
    nobody = L.predict(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nobody} == {"und"}
    one = L.predict(df.withColumn("lang", F.lit("aa"))).collect()
    assert {r["lang_pred"] for r in one} == {"und", "aa"}
    assert L.predict(df.limit(0)).count() == 0
    model = L.train_model(df)
    assert L.identify(df, model, names=("a", "b", "c")).columns == [*df.columns, "a", "b", "c"]


def test_training_sample_is_bounded_and_reaches_rare_languages(spark):
    rng = random.Random(4)
    rows = [(i, text_in(rng, "aa", 5), "aa") for i in range(3000)] + [(5000 + i, text_in(rng, "dd", 5), "dd") for i in range(7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = Counter(r["lang"] for r in L.sample_of(df, "doc_id", "text", "lang", F.lit(True), L.LanguageRules(sample_rows=100)).collect())
    assert found == {"aa": 93, "dd": 7}
