"""Packed pieces against the tokenizer's own ids: an exact round trip."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from larderline.llm import packing

P = pytest.importorskip("public_tokenizers")
FILE = P.path("word_bpe_49k.json")


def check(rows, docs, rules):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(FILE)
    want = sorted(tuple(tok.encode(t or "", add_special_tokens=False).ids) + (rules.end_id,) for _, t in docs)
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] > 0
        by_seq[r["sequence_id"]].append((r["offset"], len(ids)))
        by_doc[r["doc"]].append((r["start"], ids, r["doc_tokens"]))
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= rules.length and (at == rules.length or at & (at - 1) == 0)
    got = []
    for parts in by_doc.values():
        ids = [i for _, p, _ in sorted(parts, key=lambda x: x[0]) for i in p]
        assert all(n == len(ids) for *_, n in parts)
        got.append(tuple(ids))
    assert sorted(got) == want
    return by_seq


def test_round_trip(spark):
    rng = random.Random(1)
    odd = ["é", "ﬁ", "I'm", "it's", "１２", "a b", "x" * 300, "<|endoftext|>", "日本語", "Á", "👍", "İ", "\x00", " "]
    word = lambda: rng.choice(odd) if rng.random() < 0.1 else "".join(rng.choice("aeinrst.,'0") for _ in range(rng.randint(1, 9)))
    docs = [(i, " ".join(word() for _ in range(int(10 ** rng.uniform(0, 3.3))))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "́ ́a"), (1004, "word " * 30000)]
    rules = packing.PackRules(length=512, windows=8, known_words=500)
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), FILE, rules=rules).collect()
    seqs = check(rows, docs, rules)
    assert sum(sum(n for _, n in p) == 512 for p in seqs.values()) > 0.9 * len(seqs)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c", 1), (1, "a b c", 2), (None, "d", 3)], "doc_id long, text string, start int")
    rows = packing.pack(df, FILE).collect()
    assert sum(r["length"] for r in rows) == 4 + 4 + 2 and {r["doc"] for r in rows} == {1, None}
    assert packing.digest(df.limit(0), FILE).count() == 0


def test_digest_is_of_the_ids(spark):
    rows = packing.digest(spark.createDataFrame([(3, "One two")], "doc_id long, text string"), FILE).collect()
    from tokenizers import Tokenizer
    ids = Tokenizer.from_file(FILE).encode("One two", add_special_tokens=False).ids + [2]
    whole = np.array(ids, "<u4").tobytes()
    assert [r["doc_tokens"] for r in rows] == [len(ids)] * len(rows)
    assert all(zlib.crc32(whole[4 * r["start"]:4 * (r["start"] + r["length"])]) == r["ids_crc32"] for r in rows)
