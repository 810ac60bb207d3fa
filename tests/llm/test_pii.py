"""Permutations of small ranges in full, formats and checks of pseudonyms, and the way back."""

import random
import re
from datetime import date

import pytest

from larderline.llm import pii as P

KEY, RULES = b"k", P.PiiRules()
PATTERN = RULES.pattern()


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 256, 1000, 5000])
def test_permutes_exactly_the_range(size):
    out = [P.permuted(i, size, KEY, "t") for i in range(size)]
    assert sorted(out) == list(range(size)) and [P.permuted(x, size, KEY, "t", back=True) for x in out] == list(range(size))
    if size > 50:
        assert sum(a == b for a, b in enumerate(out)) < 10 and out != [P.permuted(i, size, b"other", "t") for i in range(size)]


def with_luhn(rng, n):
    d = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(n - 2))
    return d + next(c for c in "0123456789" if P.luhn(d + c) % 10 == 0)


def iban(rng):
    body = "".join(rng.choice("0123456789") for _ in range(18))
    return f"DE{98 - P.remainder('DE00' + body):02d}{body}"


def values(rng):
    c = with_luhn(rng, 16)
    i = iban(rng)
    return [("card", c), ("card", with_luhn(rng, 13)), ("card", "-".join(c[k:k + 4] for k in (0, 4, 8, 12))), ("phone", f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(0, 9999):04d}"),
            ("phone", f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(0, 9999):04d}"), ("phone", f"+1 (0{rng.randint(10, 99)}) 555-{rng.randint(0, 9999):04d}"), ("ipv4", f"{rng.choice([1, 126, 128, 255])}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}"),
            ("national_id", f"{rng.randint(1, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"), ("account", i), ("account", " ".join(i[k:k + 4] for k in range(0, 22, 4))),
            ("email", f"ab{rng.randint(0, 99)}.Cd@mail{rng.randint(0, 9)}.example.com"), ("day", f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"),
            ("day", f"{rng.randint(1, 28):02d}.{rng.randint(1, 12):02d}.{rng.randint(1900, 2099)}"), ("day", f"{rng.randint(1, 12):02d}/{rng.randint(1, 28):02d}/{rng.randint(1900, 2099)}"),
            ("day", f"{rng.randint(13, 28)}/{rng.randint(1, 12):02d}/{rng.randint(1900, 2099)}"), ("access_key", "AKIA" + "".join(rng.choice(P.UPPER + P.DIGITS) for _ in range(16))),
            ("secret", f"password={rng.getrandbits(72):018x}"), ("secret", f'token = "{rng.getrandbits(160):040x}')]


def shape(t):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", t)))


def test_values_keep_their_format_pass_their_check_and_come_back():
    rng = random.Random(1)
    same = total = 0
    for _ in range(60):
        for kind, v in values(rng):
            text = f"é see {v}, and {v}."
            new, found = P.pseudonymized(text, KEY, RULES, PATTERN)
            assert [k for k, *_ in found] == [kind] * 2, (v, found)
            a, b = (new[s:e] for _, s, e in found)
            assert a == b and P.pseudonymized(a, KEY, RULES, PATTERN)[1], (v, a)
            if kind not in ("secret", "access_key", "ipv4"):
                assert shape(a) == shape(v)
            assert P.pseudonymized(new, KEY, RULES, PATTERN, back=True)[0] == text
            same += a == v
            total += 1
    assert same < 5 < total


def test_equal_values_are_linked_across_notations():
    new = lambda t: P.pseudonymized(t, KEY, RULES, PATTERN)[0]
    assert P.digits_of(new("4111 1111 1111 1111")) == new("4111111111111111")
    y, m, d = new("2001-02-03").split("-")
    assert new("03.02.2001") == f"{d}.{m}.{y}" and new("02/03/2001") == f"{m}/{d}/{y}" and date(int(y), int(m), int(d))
    assert P.digits_of(new("+1 (582) 555-6684"))[1:] == P.digits_of(new("582-555-6684"))


@pytest.mark.parametrize("text", ["4111111111111112", "2001-02-30", "300.1.1.1", "127.0.0.1", "1.2.3", "000-12-3456", "666-12-3456", "DE00123456789012345678", "v1.2.3.4.5", "123-456-7890123", "a@b", "2001-02-03-04", "100-200-3000", "", "no value", "1234"])
def test_what_fails_its_check_stays(text):
    assert P.pseudonymized(text, KEY, RULES, PATTERN) == (text, [])


def test_rows_of_all_sorts(spark):
    rng = random.Random(2)
    v = values(rng)
    rows = [(1, None, 1), (2, "", 2), (3, v[0][1], 3), (3, v[0][1], 3), (None, v[5][1], 4), (4, "x " * 50000 + v[3][1] + " y" * 50000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_pii int").withColumnRenamed("n_pii", "spans")
    got = P.pseudonymize(df.withColumnRenamed("spans", "keep"), KEY).collect()
    assert {(r["doc_id"], r["keep"]): r["n_pii"] for r in got} == {(1, 1): 0, (2, 2): 0, (3, 3): 1, (None, 4): 1, (4, 5): 1} and len(got) == 6
    assert next(r["text"] for r in got if r["doc_id"] == 1) is None and P.pseudonymize(df, KEY).columns == ["doc_id", "text", "n_pii", "spans"]
    back = P.pseudonymize(P.pseudonymize(df, KEY).select("doc_id", "text"), KEY, back=True)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in back.collect()) == sorted((a or 0, b or "") for a, b, _ in rows)
    assert P.query(df.limit(0)).count() == 0


@pytest.mark.parametrize("head", ["password=", "TOKEN = ", "SECRET=", "DB_PASSWORD =", "Token= "])
@pytest.mark.parametrize("value", ["eyJhbGci.eyJzdWIi.SflKxwRJ", "p!s$wd,9", "ab1#cd\"Ef", "a-b_c/d+e" + "xY7." * 250, "0123456789abcdef" * 70, "deadbeef"])
def test_secrets_in_any_case_whole_and_back(head, value):
    for shape in ("{}", '"{}"', "'{}'") if '"' not in value else ("{}", "'{}'"):
        text = f"set {head}{shape.format(value)} then stop"
        new, found = P.pseudonymized(text, KEY, RULES, PATTERN)
        assert [k for k, *_ in found] == ["secret"] and new.startswith(f"set {head}") and new.endswith(" then stop") and len(new) == len(text)
        inner = new[len(f"set {head}"):-len(" then stop")].strip("\"'")
        same = [a == b for a, b in zip(inner, value) if b.isalnum()]
        assert sum(same[:256]) < 0.5 * len(same[:256]) and sum(same) < 0.3 * len(same) + 3
        assert all((a == b) if not b.isalnum() else a.isalnum() for a, b in zip(inner, value))
        assert P.pseudonymized(new, KEY, RULES, PATTERN, back=True)[0] == text


def test_secrets_end_at_their_quote_or_blank():
    text = 'TOKEN = "two words, one value" and {"password=abcdefgh","user":"bob"} token == other'
    new, found = P.pseudonymized(text, KEY, RULES, PATTERN)
    assert [(a, b) for _, a, b in found] == [(0, text.index('" and')), (text.index("password"), text.index('","'))]
    assert new[text.index('","'):] == text[text.index('","'):] and P.pseudonymized(new, KEY, RULES, PATTERN, back=True)[0] == text
    one = [P.pseudonymized(f"token={v}", KEY, RULES, PATTERN)[0] for v in ("deadbeef", "deadbeef,", '"deadbeef"')]
    assert {x.strip('",').replace('"', "") for x in one} == {one[0]}


def test_day_first_dates_stay_day_first_and_come_back():
    rng = random.Random(4)
    for _ in range(200):
        v = f"{rng.randint(13, 28)}/{rng.randint(1, 12):02d}/{rng.randint(1900, 2099)}"
        new = P.day(v, KEY, False)
        assert int(new[:2]) > 12 and P.day(new, KEY, True) == v
