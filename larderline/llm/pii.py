"""Format-preserving pseudonyms for personal data: validated numbers, dates and addresses, permuted by a keyed Feistel network.

A value that passes its kind's check (check digits, ranges, the calendar) is read as one number in a mixed radix, which
a keyed permutation of exactly that range maps to another; the result is written in the same format and passes the
same check. Equal values get equal pseudonyms wherever they stand, in whatever notation, and the holder of the key can
turn them back.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from datetime import date, timedelta
from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import fresh, slices, with_fields

ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEX = "0123456789abcdef"
NOBODY = ("127.0.0.1", "255.255.255.255")
BLOCK = 256                # characters of a secret that are permuted as one number
ENDS = ".,;:!?)]}>'\"\\"    # signs behind a value, which don't tell whether it is hexadecimal


def permuted(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0 .. size-1: Feistel rounds over two halves of the next even power of two, walked on
    until the value is in range again."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1

    def mixed(r: int, x: int) -> int:
        return int.from_bytes(hashlib.shake_256(key + f"|{tweak}|{size}|{r}|{x}".encode()).digest((half + 7) // 8), "big") & mask

    while True:
        left, right = value >> half, value & mask
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ mixed(r, left), left
            else:
                left, right = right, left ^ mixed(r, right)
        value = left << half | right
        if value < size:
            return value


def recoded(text: str, alphabets: list[str], key: bytes, tweak: str, back: bool) -> str:
    """``text`` with each character permuted within its alphabet, all as one number."""
    value, size = 0, 1
    for c, a in zip(text, alphabets):
        value, size = value * len(a) + a.index(c), size * len(a)
    value = permuted(value, size, key, tweak, back)
    out = []
    for a in reversed(alphabets):
        value, at = divmod(value, len(a))
        out.append(a[at])
    return "".join(reversed(out))


def kinds_of(text: str) -> list[str]:
    """The alphabet of each character: digits, capitals, small letters; anything else stands for itself."""
    return [next((a for a in (DIGITS, UPPER, LOWER) if c in a), c) for c in text]


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def refilled(text: str, digits: str) -> str:
    """``text`` with its digits replaced one by one."""
    rest = iter(digits)
    return "".join(next(rest) if c in DIGITS else c for c in text)


def luhn(digits: str) -> int:
    """Sum whose last digit is 0 for a valid number."""
    return sum(int(c) if k % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for k, c in enumerate(reversed(digits)))


def card(text: str, key: bytes, back: bool) -> str | None:
    d = digits_of(text)
    if not 13 <= len(d) <= 19 or d[0] not in "23456" or luhn(d) % 10:
        return None
    # the first digit (the network) stays, the last one is computed
    body = d[0] + recoded(d[1:-1], [DIGITS] * (len(d) - 2), key, "card" + d[0], back)
    return refilled(text, body + str(-luhn(body + "0") % 10))


def phone(text: str, key: bytes, back: bool) -> str | None:
    """Ten digits, with or without the country's 1 ahead.

    Assigned numbers (area and exchange from 200 on) stay assigned ones. Others count as numbers only behind +1, and
    are permuted among themselves.
    """
    d = digits_of(text)
    lead, d = d[:-10], d[-10:]
    if len(d) != 10 or lead not in ("", "1"):
        return None
    high = "23456789"
    if d[0] in high and d[3] in high:
        return refilled(text, lead + recoded(d, [high, DIGITS, DIGITS, high] + [DIGITS] * 6, key, "phone", back))
    if not text.startswith("+1"):
        return None
    while True:
        d = recoded(d, [DIGITS] * 10, key, "phone, other", back)
        if d[0] not in high or d[3] not in high:
            return refilled(text, lead + d)


def national_id(text: str, key: bytes, back: bool) -> str | None:
    """Nine digits as 3-2-4: area 001 to 899 but 666, group from 01, serial from 0001."""
    a, g, s = (int(x) for x in text.split("-"))
    if not 0 < a < 900 or a == 666 or not g or not s:
        return None
    a -= 1 + (a > 666)
    value = permuted((a * 99 + g - 1) * 9999 + s - 1, 898 * 99 * 9999, key, "id", back)
    value, s = divmod(value, 9999)
    a, g = divmod(value, 99)
    return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"


def ipv4(text: str, key: bytes, back: bool) -> str | None:
    """Four numbers up to 255 without leading zeros, the first not 0; this machine and broadcast are nobody's."""
    parts = [int(x) for x in text.split(".")]
    if any(p > 255 for p in parts) or not parts[0] or text in NOBODY or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    while True:
        first, *rest = permuted(int.from_bytes(bytes([parts[0] - 1, *parts[1:]]), "big"), 255 << 24, key, "ipv4", back).to_bytes(4, "big")
        parts = [first + 1, *rest]
        if (new := ".".join(map(str, parts))) not in NOBODY:
            return new


def remainder(text: str) -> int:
    """The number of an account text modulo 97, its country and check digits moved to the end, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def account(text: str, key: bytes, back: bool) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or remainder(plain) != 1:
        return None
    body = recoded(plain[4:], kinds_of(plain[4:]), key, "account" + plain[:2], back)
    new = iter(plain[:2] + f"{98 - remainder(plain[:2] + '00' + body):02d}" + body)
    return "".join(c if c == " " else next(new) for c in text)


def day(text: str, key: bytes, back: bool) -> str | None:
    """Dates as 2001-02-03, 03.02.2001 or 02/03/2001 (month first; day first where only that is a date).

    Dates written day first between slashes have a day above 12, and so have their pseudonyms: they are permuted among
    themselves, and linked to each other but not to the other notations.
    """
    a, sign, b, _, c = re.split(r"([-./])", text)
    order = (0, 1, 2) if sign == "-" else (2, 1, 0) if sign == "." else (2, 0, 1)
    for o in (order, (2, 1, 0)) if sign == "/" else (order,):
        try:
            told = date(*(int((a, b, c)[k]) for k in o))
        except ValueError:
            continue
        if not FIRST_DAY <= told <= LAST_DAY:
            return None
        day_first = sign == "/" and o == (2, 1, 0)
        new = told
        while new is told or day_first and new.day <= 12:
            new = FIRST_DAY + timedelta(permuted((new - FIRST_DAY).days, (LAST_DAY - FIRST_DAY).days + 1, key, "day first" if day_first else "day", back))
        out = [""] * 3
        for k, v in zip(o, (new.year, new.month, new.day)):
            out[k] = f"{v:04d}" if v > 31 else f"{v:02d}"
        return sign.join(out)
    return None


def email(text: str, key: bytes, back: bool) -> str | None:
    """The part before the sign is permuted, letter for letter and digit for digit; the domain stays."""
    local, domain = text.rsplit("@", 1)
    return f"{recoded(local, kinds_of(local), key, 'email' + domain.lower(), back)}@{domain}"


def access_key(text: str, key: bytes, back: bool) -> str | None:
    """Keys of four fixed letters and sixteen capitals or digits 2 to 7 (and others)."""
    return text[:4] + recoded(text[4:], [UPPER + DIGITS] * (len(text) - 4), key, "key" + text[:4], back)


def secret(text: str, key: bytes, back: bool) -> str | None:
    """A value behind ``password=`` or ``TOKEN =``: hex digits stay hex digits, others keep their class, signs and letters
    beyond A-Z stand for themselves. A long value goes block by block, each under the hash of the plain ones before."""
    head, quote, value = re.fullmatch(r"""((?:password|token|secret)\s*=\s*)(["']?)(.*)""", text, re.I | re.S).groups()
    core = value.rstrip(ENDS)
    alphabets = [HEX] * len(core) if all(c in HEX for c in core) else kinds_of(core)
    if all(len(a) == 1 for a in alphabets):
        return None
    out, tweak, before = [], "secret", hashlib.sha256()
    for at in range(0, len(core), BLOCK):
        old = core[at:at + BLOCK]
        out.append(new := recoded(old, alphabets[at:at + BLOCK], key, tweak, back))
        before.update((new if back else old).encode("utf-8", "surrogatepass"))
        tweak = "secret" + before.hexdigest()
    return head + quote + "".join(out) + value[len(core):]


@dataclass(frozen=True)
class PiiRules:
    """Kinds in order of precedence: name, pattern, pseudonym (None: not valid). Patterns are fixed formats."""
    kinds: tuple[tuple[str, str, Callable], ...] = field(default=(
        ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])", email),
        ("secret", r"(?<![A-Za-z])(?i:password|token|secret)\s{0,3}=\s{0,3}"
         r"""(?:"(?:[^"\\\r\n]|\\.){6,}(?="(?![A-Za-z0-9]))|'(?:[^'\\\r\n]|\\.){6,}(?='(?![A-Za-z0-9]))"""
         r"""|["']?(?=(?:[^\s"]|"(?=[A-Za-z0-9])){6})(?:[^\s"]|"(?=[A-Za-z0-9]))*[^\s.,;:!?)\]}>'"\\])""", secret),
        ("access_key", r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])", access_key),
        ("account", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", account),
        ("card", r"(?<![0-9A-Za-z.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]|[.-][0-9])", card),
        ("ipv4", r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])", ipv4),
        ("day", r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9A-Za-z]|[./-][0-9])", day),
        ("national_id", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])", national_id),
        ("phone", r"(?<![0-9A-Za-z.])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])", phone)))

    def pattern(self) -> re.Pattern:
        return re.compile("|".join(f"(?P<{n}>{p})" for n, p, _ in self.kinds))


def pseudonymized(text: str, key: bytes, rules: PiiRules, pattern: re.Pattern, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of each in the new text."""
    out, found, at, size = [], [], 0, 0
    place = 0
    while m := pattern.search(text, place):
        new = kind = None
        for n, p, f in rules.kinds:       # where one kind's check fails, another kind may stand at this place
            if (own := re.compile(p).match(text, m.start())) and (new := f(own[0], key, back)) is not None:
                kind, m = n, own
                break
        if kind is None:
            place = m.start() + 1
            continue
        out += [text[at:m.start()], new]
        size += m.start() - at
        found.append((kind, size, size + len(new)))
        size += len(new)
        at = place = m.end()
    return "".join(out) + text[at:], found


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text", rules: PiiRules = PiiRules(), back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in the text, and n_pii and spans (kind, start, end: characters of the new text).

    ``key``: secret bytes; equal values have equal pseudonyms under equal keys. ``back`` turns pseudonyms into values.
    Values that fail their kind's check stay as they are; of overlapping values, the first in the text, then the first
    kind, counts. A value may be its own pseudonym, as for any permutation, about once in the number of its kind's values.

    A secret goes up to its closing quote on the line, else to the next blank or closing quote, from six characters on and
    of any length, without the stops and brackets at its end; what else stands there without a blank is taken for part of it.

    A null text stays null, with 0 and no span. Whole texts are read, one at a time; repeated rows get equal answers.
    Other columns pass, n_pii and spans are replaced; an empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("n_pii", "spans")]
    pattern, name = rules.pattern(), fresh(docs, "text_in")
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            new = [(None, []) if t is None else pseudonymized(t, key, rules, pattern, back) for t in batch.column(name).to_pylist()]
            out = {c: pa.array([t for t, _ in new], pa.string()) if c == text else batch.column(c) for c in kept}
            yield pa.RecordBatch.from_pydict(out | {"n_pii": pa.array([len(f) for _, f in new], pa.int64()), "spans": pa.array([[dict(zip(("kind", "start", "end"), x)) for x in f] for _, f in new], struct)})

    # the text goes in once: under its own name there would be two copies
    slim = docs.select(*(F.lit(None).cast("string").alias(c) if c == text else F.col(c) for c in kept), F.col(text).cast("string").alias(name))
    return slim.mapInArrow(run, with_fields(docs, kept, "n_pii long, spans array<struct<kind: string, start: bigint, end: bigint>>", text))


#: For the registered query only; a deployment passes its own secret.
EXAMPLE_KEY = b"example key of the registered query"


def query(docs: DataFrame) -> DataFrame:
    return pseudonymize(docs.select("doc_id", "text"), EXAMPLE_KEY)
