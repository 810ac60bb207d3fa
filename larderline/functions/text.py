"""Names, addresses, tokens, statuses and hashes as Spark SQL expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from typing import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Characters that count as white space.
WHITE = "".join(chr(i) for i in range(0x10000) if chr(i).isspace())


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition holds ASCII: one-letter and longer ones."""
    one_from, one_to, longer = [], [], {}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one_from.append(chr(code))
            one_to.append(plain)
        elif plain:
            longer[chr(code)] = plain
    return "".join(one_from), "".join(one_to), longer


def constant_map(entries: Mapping[str, str]) -> Column:
    """A map as one text literal, which the optimizer turns into a map literal once."""
    text = "\x01".join(f"{k}\x02{v}" for k, v in entries.items())
    return F.str_to_map(F.lit(text), F.lit("\x01"), F.lit("\x02"))


def _ranges(chars: Sequence[str]) -> str:
    """Characters as ranges of a regex class."""
    codes, out = sorted(map(ord, chars)), []
    for code in codes:
        if out and out[-1][1] == code - 1:
            out[-1][1] = code
        else:
            out.append([code, code])
    return "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in out)


def fold(c: Column) -> Column:
    """ASCII form of a text: accents dropped, compatibility forms spelled out, the rest removed."""
    one_from, one_to, longer = _fold_tables()
    # after one-letter forms are replaced, only ASCII and the longer forms are of interest; ASCII is passed over by a cheap test first
    single = F.regexp_replace(F.translate(c, one_from, one_to), r"(?=[^\x00-\x7F])[^\x00-\x7F" + _ranges(list(longer)) + "]", "")
    spell = constant_map(longer)
    pieces = F.regexp_extract_all(single, F.lit(r"([\x00-\x7F]+|[^\x00-\x7F])"), F.lit(1))
    spelled = F.array_join(F.transform(
        pieces, lambda p: F.when(p.rlike(r"^[\x00-\x7F]"), p).otherwise(spell[p])), "")
    return F.when(c.rlike(r"[^\x00-\x7F]"), spelled).otherwise(c)


def normal_name(c: Column) -> Column:
    """Lower-case ASCII name with separators as single spaces; the key of duplicates and overlays."""
    spaced = F.regexp_replace(F.lower(fold(c)), r"[-/&+]", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, r"[^a-z0-9 ]", ""), " +", " "))


def name_tokens(c: Column, stop_words: Sequence[str]) -> Column:
    """Identity tokens of a business name: stop words removed, plural s dropped."""
    s = F.lower(fold(F.coalesce(c, F.lit(""))))
    s = F.regexp_replace(F.regexp_replace(s, r"[.']", ""), "&", " and ")
    words = F.split(F.trim(F.regexp_replace(s, r"[^a-z0-9]+", " ")), " ")
    stop = F.array(*[F.lit(w) for w in (*stop_words, "")])
    kept = F.filter(words, lambda w: ~F.array_contains(stop, w))
    return F.transform(kept, lambda w: F.when(
        (F.length(w) > 3) & w.endswith("s") & ~w.endswith("ss"), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w))


def slug(c: Column) -> Column:
    s = F.regexp_replace(F.lower(fold(c)), r"[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(s, r"^-+|-+$", ""), F.lit("")), F.lit("x"))


_NUMBER = r"^\s*(\d+)[a-z]?(?:\s*[-;]\s*\d+)?\s+"
# fixed values: words before the street name that do not identify it
_DIRECTIONS = ("n", "s", "e", "w", "north", "south", "east", "west", "the", "a", "b")


def street_key(c: Column) -> Column:
    """``number|street word`` of an address, null when it does not start with a number."""
    s = F.lower(fold(c))
    number = F.regexp_extract(s, _NUMBER + r"[a-z0-9]+", 1)
    first = F.regexp_extract(s, _NUMBER + r"([a-z0-9]+)", 2)
    second = F.regexp_extract(s, _NUMBER + r"[a-z]+\s+([a-z0-9]+)", 2)
    street = F.when(first.isin(*_DIRECTIONS) & (second != ""), second).otherwise(first)
    return F.when(number != "", F.concat_ws("|", number, street))


def title_case(c: Column) -> Column:
    """Capital after every non-letter, as in ``Don'T``."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def placard(c: Column) -> Column:
    """Inspection status with its misspellings resolved; blank is null."""
    s = F.upper(strip(c))
    return (F.when(s == "", None)
            .when(s.startswith("CONDIT"), "Conditional Pass")
            .when(s.startswith("PASS"), "Pass")
            .when(s.startswith("CLOS"), "Closure")
            .otherwise(title_case(s)))


def violation_codes(c: Column) -> Column:
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\b(\d{6}(?:\.\d+)?)\b"), F.lit(1))
    return F.array_sort(F.array_distinct(found))


def zip5(c: Column) -> Column:
    return F.substring(F.coalesce(c, F.lit("")), 1, 5)


def strip(c: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.trim(c, F.lit(WHITE))


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends; null is empty."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), f"[{_ranges(WHITE)}]+", " "))


def short_number(c: Column) -> Column:
    """A number in six significant digits without trailing zeros, with an exponent below 1e-4 and from 1e6 on:
    16, 5.3, 12.3457, 1.23457e+06. Text that is no number is kept."""
    n = c.try_cast("double")
    shown = F.format_string("%.5e", n)
    exponent = F.split(shown, "e")[1].cast("int")
    sign, digits = F.when(shown.startswith("-"), "-").otherwise(""), F.regexp_replace(F.split(shown, "e")[0], "[-.]", "")
    zeros = lambda s: F.regexp_replace(s, r"(?:(\.[0-9]*[1-9])|\.)0*$", "$1")
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    plain = F.concat(F.substring(digits, F.lit(1), exponent + 1), F.lit("."), F.substring(digits, exponent + 2, F.lit(6)))
    power = F.concat(zeros(F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 5))), F.lit("e"), F.split(shown, "e")[1])
    written = F.when((exponent < -4) | (exponent >= 6), power).otherwise(zeros(F.when(exponent < 0, small).otherwise(plain)))
    odd = F.when(F.isnan(n), "nan").when(n == float("inf"), "inf").when(n == float("-inf"), "-inf")
    return F.when(n.isNull(), c.cast("string")).otherwise(F.coalesce(odd, F.concat(sign, written)))


def search_tokens(c: Column, prefix_length: int) -> Column:
    """Words of more than two letters without their plural ending, and the ``~prefix`` key of the long ones.

    The ending is taken off in the text as a whole: es (tomatoes) unless the
    word ends in ses, else s (pizzas) unless it ends in ss.
    """
    return _tokens_of(F.lower(fold(F.coalesce(c, F.lit("")))), prefix_length)


def _tokens_of(text: Column, prefix_length: int) -> Column:
    stemmed = F.regexp_replace(text, r"(?<![a-z])([a-z]{2,}[a-rt-z])es(?![a-z])", "$1")
    stemmed = F.regexp_replace(stemmed, r"(?<![a-z])([a-z]{2,}[a-rt-z])s(?![a-z])", "$1")
    words = F.regexp_extract_all(stemmed, F.lit("([a-z]{3,})"), F.lit(1))
    keys = F.regexp_extract_all(text, F.lit(f"([a-z]{{{prefix_length}}})[a-z]*"), F.lit(1))
    return F.concat(words, F.transform(keys, lambda k: F.concat(F.lit("~"), k)))


def distinct_search_tokens(c: Column, prefix_length: int) -> Column:
    """The different ``search_tokens`` of a long text. Equal words are left out before, as no token spans a blank."""
    # a list of one names a step, which is worked out once
    once = lambda value, then: F.transform(F.array(value), then)[0]
    words = F.array_join(F.array_distinct(F.split(F.coalesce(c, F.lit("")), r"[\x00-\x20]+")), " ")
    return once(words, lambda w: once(F.lower(fold(w)), lambda text: F.array_distinct(_tokens_of(text, prefix_length))))


def alias_words(tokens: Column, aliases: Mapping[str, str]) -> Column:
    """The words that the tokens stand for, as one text."""
    table = constant_map(aliases)
    return F.array_join(F.filter(F.transform(tokens, lambda t: table[t]), lambda w: w.isNotNull()), " ")


def text_hash(c: Column, n: int = 20) -> Column:
    return F.substring(F.sha2(c, 256), 1, n)


def item_text(section: Column, name: Column, description: Column) -> Column:
    """Text of an item as a reader sees it; blank parts are left out."""
    def part(label: str, c: Column) -> Column:
        return F.when(c != "", F.concat(F.lit(label), c))
    return F.concat_ws("\n", part("Section: ", section), F.concat(F.lit("Item: "), name),
                       part("Description: ", description))


def quotes(words: Column, text: Column) -> Column:
    """Words, trimmed, that occur in the text whatever their case."""
    low = F.lower(text)
    trimmed = F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: strip(w))
    return F.filter(trimmed, lambda w: (w != "") & F.contains(low, F.lower(w)))


def distinct_words(words: Column) -> Column:
    """Case-insensitive distinct words, first spelling kept, sorted without case."""
    lows = F.transform(words, F.lower)
    return F.transform(F.array_sort(F.array_distinct(lows)),
                       lambda w: F.element_at(words, F.array_position(lows, w).cast("int")))


def _longest_block(x: Column, y: Column) -> Column:
    """(k, -i) of the longest block of ``x`` that ``y`` holds, the first in ``x`` on a tie; null for none. Both have a character."""
    n = F.length(x)
    blocks = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.when(
        F.contains(y, F.substring(x, i, k)), F.struct(k.alias("k"), (-i).alias("i"))))))
    return F.array_max(blocks)


def similarity(a: Column, b: Column, least: float = 0.0) -> Column:
    """Share of two texts' characters in matching blocks: the longest common block, then the longest on either side of it, and so on.

    Null in, null out; two empty texts are equal. For short texts such as names: each step looks at all blocks of a part.
    The search ends where what is left can't reach ``least`` any more; the share is then below it, and no more than that is known.
    """
    part = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    open_ = lambda parts: F.filter(parts, lambda p: (p["x"] != "") & (p["y"] != ""))
    state = lambda work, matched: F.struct(work.alias("work"), matched.cast("int").alias("matched"))

    def step(acc: Column, _: Column) -> Column:
        head, rest = acc["work"][0], F.slice(acc["work"], F.lit(2), F.greatest(F.size(acc["work"]) - 1, F.lit(0)))

        def after(m: Column) -> Column:
            x, y, k, i = head["x"], head["y"], m["k"], -m["i"]
            j = F.instr(y, F.substring(x, i, k))
            sides = F.array(part(F.substring(x, F.lit(1), i - 1), F.substring(y, F.lit(1), j - 1)), part(F.substring(x, i + k, F.length(x)), F.substring(y, j + k, F.length(y))))
            return F.when(m.isNull(), hopeful(rest, acc["matched"])).otherwise(hopeful(F.concat(rest, open_(sides)), acc["matched"] + k))

        def hopeful(work: Column, matched: Column) -> Column:
            """The state, its work taken away if it can't lead to ``least``."""
            reach = lambda w: F.aggregate(w, matched.cast("int"), lambda n, p: n + F.least(F.length(p["x"]), F.length(p["y"])))
            return F.transform(F.array(work), lambda w: state(F.when(2.0 * reach(w) >= least * both, w).otherwise(F.slice(w, 1, 0)), matched))[0]

        # a list of one names the block, which is looked for once
        return F.when(F.size(acc["work"]) == 0, acc).otherwise(F.transform(F.array(_longest_block(head["x"], head["y"])), after)[0])

    both = F.length(a) + F.length(b)
    found = F.aggregate(F.sequence(F.lit(0), 2 * F.length(a)), state(open_(F.array(part(a, b))), F.lit(0)), step)["matched"]
    return F.when(a.isNull() | b.isNull(), None).when(both == 0, 1.0).otherwise(2.0 * found / both)


def similarity_ceiling(a: Column, b: Column) -> Column:
    """Upper bound of ``similarity`` from the lengths and the letters that only one text has, to spare hopeless pairs the search."""
    shared = lambda x, y: F.length(x) - F.length(F.call_function("translate", x, y, F.lit("")))
    return 2.0 * F.least(shared(a, b), shared(b, a)) / F.greatest(F.length(a) + F.length(b), F.lit(1))
