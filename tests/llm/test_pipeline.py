"""The pipeline on a small corpus: each stage against plain loops on the stage's own input."""

import random
from collections import Counter

import pytest
import regex

pytest.importorskip("public_tokenizers")


def corpus():
    rng = random.Random(9)
    alphabets = {"en": "etaoinshrdl", "de": "äöüßcgkwz", "fr": "éèêçvqxyj"}
    word = lambda lang: "".join(rng.choice(alphabets[lang]) for _ in range(rng.randint(2, 8)))
    line = lambda lang, n: " ".join(word(lang) for _ in range(n))
    items = [(i, line("en", rng.randint(12, 40))) for i in range(12)]
    shared = [line("en", 60), "All rights reserved here."]
    docs = []
    for i in range(300):
        lang = rng.choice(list(alphabets))
        lines = [line(lang, rng.randint(10, 60)) for _ in range(rng.randint(2, 6))]
        if i % 5 == 0:
            lines.insert(rng.randint(0, len(lines)), rng.choice(shared))
        if i % 11 == 0:
            a = rng.choice(items)[1].split()
            cut = rng.randint(0, len(a))
            lines.append(" ".join(a[cut:] + a[:cut]))
        docs.append((i, "\n".join(lines), lang, f"s{i % 9}"))
    for i in range(40):  # exact and near copies of documents on one site
        _, t, lang, source = docs[i * 3]
        w = t.split(" ")
        if i % 2:
            w[rng.randrange(len(w))] = word(lang)
        docs.append((1000 + i, " ".join(w), lang, source))
    docs += [(2000, None, "en", "s1"), (2001, "", None, None), (2002, "123 456", "en", "s2"), (2003, shared[0], "en", "s3"), (2004, shared[1] + "\n" + shared[0], "en", "s4")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in docs], items


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def key(r):
    return tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r)


def test_stages_one_after_the_other(spark, tmp_path):
    import corpus_pipeline as C
    from tests.llm import test_line_dedup as lines
    from tests.llm.test_near_words import near_pairs, similar

    docs, items = corpus()
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in C.STAGES] == ["language", "line_dedup", "simhash", "decontaminate", "packing"]
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    tables = [docs]
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == frame.columns and out.schema.simpleString() == frame.schema.simpleString()
        out.write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        tables.append([tuple(r) for r in frame.collect()])
    told, clean, single, safe = tables[1:]

    assert {r[0] for r in docs} - {r[0] for r in told} == {2000, 2001, 2002}
    want = [(i, t, lang, s, len(t)) for (i, t, _, gone), (_, old, lang, s, _) in zip(lines.plain([(a, b, d, "") for a, b, c, d, e in told], 5), told) if gone == 0 or t.strip()]
    assert sorted(clean, key=key) == sorted(want, key=key) and len(clean) == len(told) - 2 and sum(len(r[1]) for r in clean) < sum(len(r[1]) for r in told)

    pairs, sets = near_pairs([r[1] for r in clean])
    kept = {r[0] for r in single}
    place = {r[0]: k for k, r in enumerate(clean)}
    assert kept < place.keys() and len(kept) < len(clean) - 20
    assert not any(clean[a][0] in kept and clean[b][0] in kept for a, b in pairs)
    assert all(any(similar(sets[place[d]], sets[place[e]]) >= 0.8 for e in kept) for d in place.keys() - kept)

    tokens = lambda x: regex.findall(r"[\p{L}\p{N}]+", x.lower())
    from tests.llm.test_decontaminate import plain_tiles
    held = {i for i, t, *_ in single if any(sum(k for *_, k in plain_tiles(tokens(t), tokens(x), 5)) >= 0.5 * len(tokens(x)) for _, x in items if set(tokens(x)) & set(tokens(t)))}
    assert {r[0] for r in single} - {r[0] for r in safe} == held and len(held) > 10

    pieces = C.run(spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in pieces).keys() == {r[0] for r in safe}
    assert sum(r["length"] for r in pieces) == sum({r["doc_id"]: r["doc_tokens"] for r in pieces}.values())


def test_other_columns_of_any_name_pass(spark, tmp_path):
    import corpus_pipeline as C
    docs, items = corpus()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = spark.createDataFrame([(*d, 1, "x", 0.5) for d in docs[:60]], SCHEMA + ", n_removed int, lang_pred string, score double")
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == frame.columns
        frame = spark.createDataFrame(out.collect(), frame.schema)
    assert {(r["n_removed"], r["lang_pred"], r["score"]) for r in frame.collect()} == {(1, "x", 0.5)}
