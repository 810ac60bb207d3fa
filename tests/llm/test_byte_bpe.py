"""Encoding against the public library, exact round trips, edits against encoding anew."""

import hashlib
import random
import time

import numpy as np
import pytest

from larderline.llm import byte_bpe
from larderline.llm.byte_bpe import BpeRules, Draft, Vocabulary

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
RULES = BpeRules(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
MULTI = BpeRules(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
TEXTS = [None, "", " ", "\n\n  x\n", "It's they'll we'Re 'tis ''re", "naïve façade 東京タワー 🤖👩‍👩‍👧", "<|endoftext|> is text", "a" * 300, "1234567890" * 30, "\x00\x1c\x85 ﻿",
         "    if (x == 0):\n\treturn  None   ", "x" + " " * 200 + "y", "ab" * 5000, "É" * 99, "é ñ", "aaaa bbbb\r\n\r\ncccc"]


def library(rules):
    return tiktoken.Encoding("own", pat_str=rules.pattern, mergeable_ranks=Vocabulary.of(rules).ranks, special_tokens={})


def ids(rules, text):
    return np.frombuffer(b"".join(Vocabulary.of(rules).encode(text)), np.uint32).tolist()


@pytest.mark.parametrize("rules", [RULES, MULTI])
def test_ids_equal_the_library(rules):
    theirs, rng = library(rules), random.Random(3)
    letters = "etaoin shrdlu'ABC019.,-\n\té東🤖ßж "
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(letters, k=rng.randrange(1, 120))) for _ in range(500)]
    for t in texts:
        assert ids(rules, t) == theirs.encode_ordinary(t)
        assert Vocabulary.of(rules).decode(ids(rules, t)) == t.encode()


def test_every_character_equals_the_library():
    theirs = library(RULES)
    for first in range(0, 0x110000, 4096):
        text = "".join(f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in range(first, first + 4096) if not 0xD800 <= c < 0xE000)
        assert ids(RULES, text) == theirs.encode_ordinary(text)


def test_parts_of_a_text_are_held_a_block_at_a_time():
    small = BpeRules(RULES.ranks, RULES.pattern, known_pieces=3, block=4)
    text = "one two  three\nfour five six seven eight nine ten"
    assert ids(small, text) == ids(RULES, text)


def test_long_pieces_are_linear():
    v, rng = Vocabulary.of(RULES), random.Random(1)
    def seconds(n):
        data = bytes(rng.choices(b"abcdefghij", k=n))
        start = time.perf_counter()
        v.piece(data)
        return time.perf_counter() - start
    seconds(200_000)
    assert seconds(400_000) < 8 * max(seconds(100_000), 0.05)


def test_prefixes_hold_the_last_token_of_each_prefix():
    v, data = Vocabulary.of(RULES), "unbelievably interoperable".encode()
    last = v.prefixes(data)
    assert all(v.merged(data[:k + 1])[-1] == last[k] for k in range(len(data)))


def test_edits_equal_encoding_anew():
    v, theirs, rng = Vocabulary.of(RULES), library(RULES), random.Random(9)
    letters = ["a", "re", "'", "'r", " ", "  ", "\n", "1", ".", "é", "word", "’s", "🤖", "\t"]
    for _ in range(150):
        draft = Draft(v, "".join(rng.choices(letters, k=rng.randrange(0, 30))))
        for _ in range(12):
            a = rng.randrange(len(draft.text) + 1)
            b = min(len(draft.text), a + rng.choice((0, 0, 1, 2, 9)))
            a, b = (len(draft.text),) * 2 if rng.random() < 0.3 else (a, b)
            text = draft.text[:a] + (new := "".join(rng.choices(letters, k=rng.randrange(0, 4)))) + draft.text[b:]
            draft.replace(a, b, new)
            assert draft.text == text and draft.ids() == theirs.encode_ordinary(text)
    with pytest.raises(IndexError):
        draft.replace(3, 2, "")


def test_edits_work_near_their_place():
    draft = Draft(Vocabulary.of(RULES), "some words of a long text, " * 2000)
    before = draft.worked
    draft.replace(20_000, 20_004, "new")
    draft.append(" end")
    assert draft.worked - before < 60
    word = Draft(Vocabulary.of(RULES), "ab" * 10_000)   # one piece
    before = word.worked
    word.append("ab")
    assert word.worked - before == 2 and word.ids() == library(RULES).encode_ordinary(word.text)


def test_rows(spark):
    rows = [(k, t, "x", 1) for k, t in enumerate(TEXTS)] + [(None, "twice", None, None), (None, "twice", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string, c0 int").repartition(3)
    theirs = library(RULES)
    got = sorted((r["doc_id"] is None, r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in byte_bpe.query(df, RULES).collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((k is None, k, len(t := theirs.encode_ordinary(text or "")), sha(np.array(t, "<u4").tobytes()), sha((text or "").encode())) for k, text, *_ in rows)
    assert got == want
    assert byte_bpe.query(df.limit(0), RULES).collect() == []


def test_edited_rows(spark):
    rows = [(1, "some words", 5, 5, "letters"), (2, "some words", None, None, " more"), (3, None, None, None, "new"), (4, "text", 99, 5, None), (5, "they'r", None, 0, "e"), (6, None, None, None, None)]
    got = {r["doc_id"]: r for r in byte_bpe.edit(spark.createDataFrame(rows, "doc_id long, text string, at long, removed long, added string"), RULES).collect()}
    assert {k: r["text"] for k, r in got.items()} == {1: "some letters", 2: "some words more", 3: "new", 4: "text", 5: "they're", 6: ""}
    theirs = library(RULES)
    assert all(np.frombuffer(r["token_ids"], "<u4").tolist() == theirs.encode_ordinary(r["text"]) for r in got.values())


def test_null_ids_and_unknown_ids(spark):
    df = spark.createDataFrame([(1, None), (2, bytearray(b""))], "doc_id long, token_ids binary")
    assert {r["doc_id"]: r["decoded"] for r in byte_bpe.decode(df, RULES).collect()} == {1: None, 2: b""}
    with pytest.raises(Exception):
        byte_bpe.decode(spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\x00"))], "doc_id long, token_ids binary"), RULES).collect()
