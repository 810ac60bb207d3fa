"""Closest foods for each item by shared words."""

from __future__ import annotations

from collections import Counter
from decimal import ROUND_HALF_UP, Decimal
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.config import SURVEY, FoodRules
from larderline.functions.text import alias_words, distinct_search_tokens, search_tokens, short_number
from larderline.operators.ordering import each, first_rows
from larderline.session import cut, spread


def candidate_foods(foods: DataFrame, rules: FoodRules = FoodRules()) -> DataFrame:
    """Foods an item may be mapped to, with their pool; counts are taken after this filter."""
    survey = F.col("dataType") == SURVEY
    return (foods.filter(survey | ~F.coalesce(F.col("category").isin(*rules.single_exclude), F.lit(False)))
            .withColumn("pool", F.when(survey, "dish").otherwise("single")))


def with_weights(items: DataFrame, out: str, rules: FoodRules = FoodRules()) -> DataFrame:
    """Tokens of each item with the weight of the best field they stand in, sorted by token."""
    fields = {"name": rules.name_weight, "description": rules.description_weight, "section": rules.section_weight}
    # arrays become columns of their own, so that each text is split once and not once per token
    own = items.withColumns({f"_o_{f}": search_tokens(F.col(f), rules.prefix_length) for f in fields})
    wide = own.withColumns({f"_w_{f}": F.array_distinct(F.concat(
        f"_o_{f}", search_tokens(alias_words(F.col(f"_o_{f}"), rules.aliases), rules.prefix_length))) for f in fields})
    every = wide.withColumn("_every", F.array_sort(F.array_distinct(F.concat(*[f"_w_{f}" for f in fields]))))

    def weigh(t: Column) -> Column:
        best = F.greatest(*[F.when(F.array_contains(f"_w_{f}", t), w).otherwise(0.0) for f, w in fields.items()])
        return best * F.when(t.startswith("~"), rules.prefix_weight).otherwise(1.0)

    weighed = F.transform("_every", lambda t: F.struct(t.alias("token"), weigh(t).alias("w")))
    return every.withColumn(out, weighed).drop("_every", *[f"_{k}_{f}" for f in fields for k in "ow"])


def retrieve(items: DataFrame, foods: DataFrame, rules: FoodRules = FoodRules()) -> DataFrame:
    """Top foods per item and pool: (id, pool, rank, fdcId, score).

    items: id, section, name, description; foods: fdcId, pool, description
    (see ``candidate_foods``). Score = sum over shared tokens of weight times
    ln(foods / foods with the token), taken in token order and rounded to nine
    decimals; ties go to the lower id. Rows of one id in a pool are one food, whose
    tokens count once a row.

    Equal items are looked up once. Foods are dealt by id to tasks, each of which also gets
    the tokens of all items; a pair of an item and a food is scored where the food lies, and
    only the best of a task leave it. So no token of a food and no pair is stored or shuffled.
    All tokens count alike: ``common_df`` has no effect on the work or the result.
    """
    q = F.sha2(F.concat_ws("\x1f", *[F.coalesce(c, F.lit("")) for c in ("section", "name", "description")]), 256)
    keyed = items.withColumn("q", q)
    texts = with_weights(keyed.select("q", "section", "name", "description").dropDuplicates(["q"]), "tw", rules)
    foods = foods.select("fdcId", "pool", "description")
    tokens = lambda: distinct_search_tokens(F.col("description"), rules.prefix_length)
    total = foods.agg(F.count(F.lit(1))).scalar()
    df = each(spread(foods.select("description")), tokens(), "token").groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    idf = df.select("token", F.log(total / F.col("df")).alias("idf"))
    asked = cut(each(texts, "tw", "x").select("q", "x.token", "x.w")).join(idf, "token").select("q", "token", (F.col("w") * F.col("idf")).alias("s"))
    weighed = F.array_sort(F.collect_list(F.struct("token", "s")))
    index = cut(asked.groupBy("q").agg(weighed.alias("_i")).select(
        "q", F.array_join(F.transform("_i", lambda x: x["token"]), " ").alias("description"), F.transform("_i", lambda x: x["s"]).alias("s")))

    tasks = int(foods.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    everywhere = index.withColumn("_task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    dealt = (foods.withColumn("_task", F.pmod(F.xxhash64("fdcId", "pool"), F.lit(tasks)).cast("int"))
             .unionByName(everywhere, allowMissingColumns=True).repartitionById(tasks, "_task")
             .sortWithinPartitions(F.col("q").isNull(), "fdcId", "pool"))
    words = F.when(F.col("q").isNull(), F.array_join(tokens(), " ")).otherwise(F.col("description"))
    found = dealt.select("q", "s", "fdcId", "pool", words.alias("words"))
    kept = found.select("q", "fdcId", "pool", F.lit(0.0).alias("score")).schema
    scored = found.mapInArrow(_closest(rules.per_pool), kept).withColumn("score", F.round("score", 9))
    top = first_rows(scored, ["q", "pool"], [F.desc("score"), F.asc("fdcId")], rules.per_pool)
    # at most per_pool rows per group: the rank is a window over those few
    ranked = (top.groupBy("q", "pool").agg(F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("o"), "fdcId", "score"))).alias("t"))
        .select("q", "pool", F.posexplode("t").alias("p", "x"))
        .select("q", "pool", (F.col("p") + 1).alias("rank"), "x.fdcId", "x.score"))
    return keyed.select("id", "q").join(ranked, "q").select("id", "pool", "rank", "fdcId", "score")


#: Items and foods whose scores are held at once.
ITEMS_AT_ONCE, FOODS_AT_ONCE = 1024, 2048


def _closest(per_pool: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of a task, items with their tokens and shares of the score before foods in order of their ids, to the best foods
    of each item and pool of every ``FOODS_AT_ONCE`` foods, with scores that are not rounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, lists, shares = [], [], []
        index = number = food = None
        held: list[tuple] = []   # fdcId, pool, how often it has which token
        for batch in batches:
            fields = {c: batch.schema.field(c).type for c in ("q", "fdcId", "pool")}
            read = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            for q, s, fdc, pool, words in zip(*(read[c] for c in ("q", "s", "fdcId", "pool", "words")), strict=True):
                if q is not None:
                    names.append(q)
                    lists.append(words.split(" "))
                    shares.append(s)
                    continue
                if index is None:
                    # numbers follow the order of the tokens, in which the shares are added up
                    number = {t: k for k, t in enumerate(sorted({t for ts in lists for t in ts}))}
                    index = _by_token(number, lists, shares)
                    lists, shares = [], []
                if food != (fdc, pool) or not held:
                    if len(held) >= FOODS_AT_ONCE:
                        yield from _best(held, index, names, fields, per_pool)
                        held = []
                    food = (fdc, pool)
                    held.append((fdc, pool, Counter()))
                held[-1][2].update(k for t in words.split(" ") if (k := number.get(t)) is not None)
        if held:
            yield from _best(held, index, names, fields, per_pool)

    return run


def _by_token(number: dict[str, int], lists: list[list[str]], shares: list[list[float]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each block of items: where each token begins, and by token the items that have it and their shares."""
    blocks = []
    for at in range(0, len(lists), ITEMS_AT_ONCE):
        some = lists[at:at + ITEMS_AT_ONCE]
        token = np.array([number[t] for ts in some for t in ts], np.int64)
        item = np.repeat(np.arange(len(some)), [len(ts) for ts in some])
        share = np.array([x for xs in shares[at:at + ITEMS_AT_ONCE] for x in xs], np.float64)
        order = np.argsort(token, kind="stable")
        blocks.append((np.searchsorted(token[order], np.arange(len(number) + 1)), item[order], share[order]))
    return blocks


def _best(held: list[tuple], index: list[tuple], names: list[str], fields: dict[str, pa.DataType], per_pool: int) -> Iterator[pa.RecordBatch]:
    token = np.array([k for _, _, has in held for k in has], np.int64)
    times = np.array([n for _, _, has in held for n in has.values()], np.float64)
    place = np.repeat(np.arange(len(held)), [len(has) for _, _, has in held])
    order = np.argsort(token, kind="stable")
    token, times, place = token[order], times[order], place[order]
    present, begin = np.unique(token, return_index=True)
    end = np.append(begin[1:], len(token))
    pools: dict = {}
    for k, (_, pool, _) in enumerate(held):
        pools.setdefault(pool, []).append(k)
    for block, (start, item, share) in enumerate(index):
        size = min(ITEMS_AT_ONCE, len(names) - block * ITEMS_AT_ONCE)
        score, met = np.zeros((size, len(held))), np.zeros((size, len(held)), bool)
        for k, a, b in zip(present, begin, end, strict=True):
            x, y = start[k], start[k + 1]
            if x < y:
                at = np.ix_(item[x:y], place[a:b])
                score[at] += share[x:y, None] * times[a:b]
                met[at] = True
        for pool, columns in pools.items():
            some = score[:, columns]
            nine = np.where(met[:, columns], _nine_decimals(some), -np.inf)
            first = np.argsort(-nine, axis=1, kind="stable")[:, :per_pool]   # foods are in order of their ids
            row, rank = np.nonzero(np.take_along_axis(nine, first, 1) > -np.inf)
            column = first[row, rank]
            yield pa.RecordBatch.from_arrays([
                pa.array([names[block * ITEMS_AT_ONCE + i] for i in row], fields["q"]), pa.array([held[columns[j]][0] for j in column], fields["fdcId"]),
                pa.array([pool] * len(row), fields["pool"]), pa.array(some[row, column])], ["q", "fdcId", "pool", "score"])


def _nine_decimals(x: np.ndarray) -> np.ndarray:
    """Billionths, rounded as Spark rounds to nine decimals: halves of the shortest decimal form go up."""
    scaled = x * 1e9
    whole = np.floor(scaled + 0.5)
    close = np.abs(scaled - np.floor(scaled) - 0.5) <= 1e-3 + 4 * np.spacing(scaled)
    whole[close] = [float((Decimal(repr(v)) * 10**9).to_integral_value(ROUND_HALF_UP)) for v in x[close].tolist()]
    return whole


def candidate_lists(items: DataFrame, retrieved: DataFrame, foods: DataFrame, rules: FoodRules = FoodRules()) -> DataFrame:
    """Candidates of each item as one list, single foods first; at most two pools of ``per_pool``."""
    record = F.struct(F.when(F.col("pool") == "single", 0).otherwise(1).alias("o"), "rank", "fdcId", "dataType",
                      "category", "description", F.slice("portions", 1, rules.max_portions).alias("portions"),
                      F.col("portions").alias("all_portions"))
    listed = (retrieved.join(foods.select("fdcId", "dataType", "category", "description", "portions"), "fdcId")
              .groupBy("id").agg(F.array_sort(F.collect_list(record)).alias("candidates")))
    return items.join(listed, "id", "left")


def question_text(rules: FoodRules = FoodRules()) -> Column:
    """Text of an item with its numbered candidates and their portions, as a reader is asked."""
    line = lambda label, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(label), F.col(c)))
    kind = F.when(F.col("kind") == "product", "packaged store product").otherwise("restaurant or cafe menu item")
    portions = lambda ps: F.array_join(F.transform(ps, lambda p, i: F.concat(
        F.lit("p"), (i + 1).cast("string"), F.lit(" "), p["label"], F.lit(" ("), short_number(p["grams"]), F.lit(" g)"))), "; ")
    rows = F.transform("candidates", lambda c, i: F.concat(
        F.lit("c"), (i + 1).cast("string"), F.when(c["dataType"] == SURVEY, " [DISH] ").otherwise(" [FOOD] "),
        c["description"],
        F.when(F.size(c["portions"]) > 0, F.concat(F.lit(" | portions: "), portions(c["portions"]))).otherwise("")))
    return F.concat_ws("\n", line("Section: ", "section"), F.concat(F.lit("Item: "), "name"),
                       line("Description: ", "description"), line("Package: ", "size"),
                       F.concat(F.lit("Kind: "), kind), F.lit(""), F.lit("Candidates:"),
                       F.array_join(F.coalesce(rows, F.array().cast("array<string>")), "\n"))


def record_kind(data_type: Column, category: Column, rules: FoodRules = FoodRules()) -> Column:
    """A survey entry filed in a dish group stands in for a recipe; every other record is a plain food."""
    dish = (data_type == SURVEY) & F.coalesce(category.isin(*rules.dish_categories), F.lit(False))
    return F.when(dish, "usda-mixed-dish-estimate").otherwise("usda-single-food")
