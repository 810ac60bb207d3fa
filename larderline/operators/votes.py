"""Repeated readings of an item to one answer: expressions over the samples of one row, and sums over long tables of votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.config import VoteRules
from larderline.functions.text import distinct_words, quotes, strip

SAMPLES = "array<struct<a:string,w:map<string,array<string>>,refusal:boolean>>"
CHOICES = "array<struct<c:string,p:string,refusal:boolean>>"


def route_answer(samples: Column, text: Column, agree_yes: int, agree_no: int) -> Column:
    """(answer, agree, words) of samples of (code, words).

    A yes counts only with words found in the text; a no needs none. Yes is
    tried before no, and anything short of its bar is unknown.
    """
    read = F.transform(samples, lambda s: F.struct(s["code"].alias("code"), quotes(s["words"], text).alias("q")))
    yes = F.filter(read, lambda s: (s["code"] == "y") & (F.size(s["q"]) > 0))
    no = F.filter(read, lambda s: s["code"] == "n")

    def result(answer: str, n: Column, words: Column) -> Column:
        return F.struct(F.lit(answer).alias("answer"), n.cast("int").alias("agree"), words.alias("words"))

    def said(side: Column) -> Column:
        return distinct_words(F.flatten(F.transform(side, lambda s: s["q"])))

    none = F.array().cast("array<string>")
    return (F.when(F.size(yes) >= agree_yes, result("yes", F.size(yes), said(yes)))
            .when(F.size(no) >= agree_no, result("no", F.size(no), said(no)))
            .otherwise(result("unknown", F.size(samples) - F.size(yes) - F.size(no), none)))


def route_tags(readings: DataFrame, rules: VoteRules = VoteRules()) -> DataFrame:
    """Long tag table: one row per item and attribute. A refused sample answers nothing."""
    each = readings.select("*", F.posexplode(F.array(*[F.lit(a) for a in rules.attributes])).alias("_i", "attribute"))
    votes = F.transform("samples", lambda s: F.struct(
        F.coalesce(F.substring(s["a"], F.col("_i") + 1, F.lit(1)), F.lit("u")).alias("code"),
        s["w"][F.col("attribute")].alias("words")))
    routed = route_answer(votes, F.col("text"), rules.agree_yes, rules.agree_no)
    return each.withColumn("_r", routed).select(
        *[c for c in readings.columns if c not in ("samples", "text")], "attribute", "_r.answer", "_r.agree", "_r.words")


def _top(values: Column) -> Column:
    """(count, -first position, value) of the most frequent value, the first seen on a tie."""
    counted = F.transform(F.array_distinct(values), lambda v: F.struct(
        F.size(F.filter(values, lambda x: x == v)).alias("n"),
        (-F.array_position(values, v)).alias("first"), v.alias("value")))
    return F.array_max(counted)


def _numbered(value: Column, letter: str) -> Column:
    return F.when(value.rlike(f"^{letter}[0-9]+$"), F.substring(value, 2, 18).try_cast("int"))


def route_choice(samples: Column, candidates: Column, agree_map: int, agree_portion: int) -> Column:
    """(candidate, portion, agree, reason) of samples of ("cN" or "none", "pN" or "none").

    A choice off the list and a refusal cast no vote.
    """
    picks = F.filter(F.transform(samples, lambda s: _numbered(s["c"], "c")),
                     lambda k: k.isNotNull() & (k >= 1) & (k <= candidates))
    top = _top(picks)
    none = F.size(F.filter(samples, lambda s: F.coalesce(s["c"] == "none", F.lit(False))))
    chosen = F.concat(F.lit("c"), top["value"].cast("string"))
    portions = F.filter(F.transform(F.filter(samples, lambda s: F.coalesce(s["c"] == chosen, F.lit(False))),
                                    lambda s: _numbered(s["p"], "p")), lambda p: p.isNotNull())
    portion = _top(portions)
    taken = F.coalesce(top["n"] >= agree_map, F.lit(False))
    all_none = none == F.size(samples)
    return F.struct(
        F.when(taken, top["value"]).alias("candidate"),
        F.when(taken & (portion["n"] >= agree_portion), portion["value"]).alias("portion"),
        F.when(taken, top["n"]).when(all_none, none)
        .otherwise(F.greatest(F.coalesce(top["n"], F.lit(0)), none)).alias("agree"),
        F.when(taken, "").when(all_none, "no candidate is the same food")
        .otherwise("readings do not agree on one record").alias("reason"))


def route_votes(votes: DataFrame, key: str, agree_yes: int, agree_no: int) -> DataFrame:
    """(key, answer, agree, words) from a long table of votes: key, ord, code, words, text (the same for all of a key).

    The rule of ``route_answer`` by sums, for keys with any number of votes: no list of them is built, and the words of
    an answer are no more than the different ones of its text.
    """
    read = votes.select(key, "ord", "code", quotes(F.col("words"), F.col("text")).alias("q"))
    yes, no = (F.col("code") == "y") & (F.size("q") > 0), F.col("code") == "n"
    counted = read.groupBy(key).agg(F.count_if(yes).alias("yes"), F.count_if(no).alias("no"), F.count("*").alias("n"))
    said = read.where(yes | no).select(key, "code", "ord", F.posexplode("q").alias("at", "word"))
    said = said.groupBy(key, "code", F.lower("word").alias("low")).agg(F.min_by("word", F.struct("ord", "at")).alias("word"))
    pair = F.struct("low", "word")
    sides = said.groupBy(key).agg(*(F.array_sort(F.collect_list(F.when(F.col("code") == c, pair))).alias(f"{c}_words") for c in ("y", "n")))
    words = lambda c: F.coalesce(F.transform(f"{c}_words", lambda w: w["word"]), F.array().cast("array<string>"))
    is_yes, is_no = F.col("yes") >= agree_yes, F.col("no") >= agree_no
    return counted.join(sides, key, "left").select(
        key, F.when(is_yes, "yes").when(is_no, "no").otherwise("unknown").alias("answer"),
        F.when(is_yes, F.col("yes")).when(is_no, F.col("no")).otherwise(F.col("n") - F.col("yes") - F.col("no")).cast("int").alias("agree"),
        F.when(is_yes, words("y")).when(is_no, words("n")).otherwise(F.array().cast("array<string>")).alias("words"))


def route_choices(votes: DataFrame, key: str, candidates: Column, agree_map: int, agree_portion: int) -> DataFrame:
    """(key, candidate, portion, agree, reason) from a long table of votes: key, ord, c, p; the rule of ``route_choice`` by sums."""
    def most(df: DataFrame, value: str, out: str) -> DataFrame:
        """The most frequent value of a key, the one seen first on a tie, as ``out`` (less: minus its count, value)."""
        per = df.groupBy(key, value).agg(F.count("*").alias("n"), F.min("ord").alias("first"))
        return per.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("less"), "first", F.col(value).alias("value"))).alias(out))

    pick = _numbered(F.col("c"), "c")
    counted = votes.groupBy(key).agg(F.count_if(F.col("c") == "none").alias("none"), F.count("*").alias("n"))
    top = most(votes.withColumn("k", pick).where(F.col("k").between(F.lit(1), candidates)), "k", "t")
    chosen = votes.join(top, key).where(pick == F.col("t.value")).withColumn("k", _numbered(F.col("p"), "p")).where(F.col("k").isNotNull())
    both = counted.join(top, key, "left").join(most(chosen, "k", "p"), key, "left")
    n, none = -F.col("t.less"), F.col("none")
    taken, all_none = F.coalesce(n >= agree_map, F.lit(False)), F.col("none") == F.col("n")
    return both.select(
        key, F.when(taken, F.col("t.value")).alias("candidate"), F.when(taken & (-F.col("p.less") >= agree_portion), F.col("p.value")).alias("portion"),
        F.when(taken, n).when(all_none, none).otherwise(F.greatest(F.coalesce(n, F.lit(0)), none)).cast("int").alias("agree"),
        F.when(taken, "").when(all_none, "no candidate is the same food").otherwise("readings do not agree on one record").alias("reason"))


def choice_samples(samples: Column) -> Column:
    """Stored map samples as votes: a missing part is none, a refusal is neither."""
    return F.transform(samples, lambda s: F.struct(
        F.when(s["c"].isNull(), "refused").otherwise(s["c"]).alias("c"),
        F.when(s["c"].isNull(), "none").otherwise(F.coalesce(s["p"], F.lit("none"))).alias("p")))


def parse_tag_replies(replies: DataFrame, rules: VoteRules = VoteRules()) -> DataFrame:
    """Replies (reply, stop_reason) to a sample, a refusal, or a reason why it is unusable."""
    one = "struct<answer:string,words:array<string>>"
    schema = "struct<" + ",".join(f"{a}:{one}" for a in rules.attributes) + ">"
    codes = F.create_map(*[F.lit(x) for x in ("yes", "y", "no", "n", "unknown", "u")])
    data = F.from_json("reply", schema, {"mode": "PERMISSIVE"})
    answers = F.array(*[codes[F.col(f"_d.{a}.answer")] for a in rules.attributes])
    words = F.array(*[F.struct(F.lit(a).alias("k"), F.when(
        F.col(f"_d.{a}.answer") != "unknown",
        F.filter(F.coalesce(F.col(f"_d.{a}.words"), F.array().cast("array<string>")),
                 lambda w: strip(w) != "")).alias("v")) for a in rules.attributes])
    kept = F.map_from_entries(F.filter(words, lambda e: F.coalesce(F.size(e["v"]) > 0, F.lit(False))))
    refusal = F.col("stop_reason") == "refusal"
    ended = F.col("stop_reason") == "end_turn"
    whole = ~F.exists(answers, lambda a: a.isNull())
    return (replies.withColumn("_d", data).withColumn("_ok", ended & F.coalesce(whole, F.lit(False)))
            .withColumn("refusal", refusal)
            .withColumn("a", F.when(F.col("_ok"), F.array_join(answers, "")))
            .withColumn("w", F.when(F.col("_ok"), kept))
            .withColumn("problem", F.when(refusal | F.col("_ok"), None)
                        .when(~ended, F.concat(F.lit("stop_reason "), "stop_reason")).otherwise("unparseable reading"))
            .drop("_d", "_ok"))


def parse_choice_replies(replies: DataFrame) -> DataFrame:
    """Replies of the food question: choice and portion, a refusal, or why it is unusable."""
    data = F.from_json("reply", "struct<choice:string,portion:string>", {"mode": "PERMISSIVE"})
    refusal, ended = F.col("stop_reason") == "refusal", F.col("stop_reason") == "end_turn"
    whole = F.col("_d.choice").isNotNull() & F.col("_d.portion").isNotNull()
    ok = ended & whole
    return (replies.withColumn("_d", data).withColumn("refusal", refusal)
            .withColumn("c", F.when(ok, strip(F.col("_d.choice")))).withColumn("p", F.when(ok, strip(F.col("_d.portion"))))
            .withColumn("problem", F.when(refusal | F.coalesce(ok, F.lit(False)), None)
                        .when(~ended, F.concat(F.lit("stop_reason "), "stop_reason")).otherwise("unparseable reading"))
            .drop("_d"))


def only_item_words(words: Column, text: Column) -> Column:
    """Quoted words of a sample that occur in the item; an attribute left without words is dropped."""
    low = F.lower(text)
    kept = F.transform_values(words, lambda _, ws: F.filter(
        ws, lambda w: (strip(w) != "") & F.contains(low, F.lower(strip(w)))))
    return F.map_filter(kept, lambda _, ws: F.size(ws) > 0)
