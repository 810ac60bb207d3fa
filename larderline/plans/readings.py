"""Tags, food map and pending work, from items and stored readings."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.config import FoodRules, VoteRules
from larderline.functions.text import item_text, text_hash
from larderline.operators.items import package_facts
from larderline.operators.ordering import first_rows, latest_rows
from larderline.operators.retrieval import candidate_foods, candidate_lists, question_text, record_kind, retrieve
from larderline.operators.votes import choice_samples, route_choice, route_tags

NO_TAGS = "no pinned readings for this text under the current basis"
NO_MAP = "no pinned readings for this input under the current basis"


def with_key(items: DataFrame) -> DataFrame:
    text = item_text(F.col("section"), F.col("name"), F.col("description"))
    return items.withColumn("text", text).withColumn("key", text_hash(F.col("text")))


def current(readings: DataFrame, basis: str, version: Sequence[str] = ("ord",)) -> DataFrame:
    """Readings of the basis, last one per key."""
    return latest_rows(readings.filter(F.col("basis") == basis), ["key"], list(version))


def tag_table(items: DataFrame, readings: DataFrame, basis: str, rules: VoteRules = VoteRules()) -> tuple[DataFrame, DataFrame]:
    """(long tags, untagged items): every item is in exactly one of them.

    Texts are routed once, however many items share them.
    """
    keyed = with_key(items)
    texts = keyed.select("key", "text").dropDuplicates(["key"])
    routed = route_tags(texts.join(current(readings, basis).select("key", "samples"), "key"), rules)
    tags = keyed.select("id", "key").join(routed, "key").withColumnRenamed("key", "text_hash")
    missing = keyed.join(routed.select("key").distinct(), "key", "left_anti").select(
        "id", F.col("key").alias("text_hash"), F.lit(NO_TAGS).alias("reason"))
    return tags, missing


def pending(texts: DataFrame, readings: DataFrame, basis: str, kind: str = "", ids: Sequence[str] = (),
            limit: int = 0) -> DataFrame:
    """Distinct (key, text) without a reading under the basis, the smallest keys first when limited.

    texts: id, kind, key, text.
    """
    if kind:
        texts = texts.filter(F.col("kind") == kind)
    if ids:
        texts = texts.filter(F.col("id").isin(*ids))
    read = readings.filter(F.col("basis") == basis).select("key").distinct()
    todo = first_rows(texts.select("key", "text", "id"), ["key"], [F.asc("id")]).drop("id").join(read, "key", "left_anti")
    return todo.orderBy("key").limit(limit) if limit else todo


def map_inputs(items: DataFrame, foods: DataFrame, rules: FoodRules = FoodRules()) -> DataFrame:
    """Items with their candidates, the question text and its key."""
    pool = candidate_foods(foods, rules)
    listed = candidate_lists(items, retrieve(items, pool, rules), pool, rules)
    return listed.withColumn("question", question_text(rules)).withColumn("key", text_hash(F.col("question")))


def food_map(inputs: DataFrame, readings: DataFrame, basis: str, labels: DataFrame | None = None,
             rules: FoodRules = FoodRules()) -> tuple[DataFrame, DataFrame]:
    """(decided rows, unread items).

    A label comes before any record; an item without candidates is unmapped;
    without readings it is unread; else the readings are routed to a record.
    """
    none = lambda t: F.lit(None).cast(t)
    j = inputs.join(current(readings, basis).select("key", "samples"), "key", "left")
    if labels is not None:
        j = j.join(labels.select("id", F.lit(True).alias("labelled"), F.col("serving_g").alias("label_g")), "id", "left")
    else:
        j = j.withColumn("labelled", none("boolean")).withColumn("label_g", none("double"))
    size = F.coalesce(F.size("candidates"), F.lit(0))
    has_candidates = size > 0
    j = j.withColumn("_v", route_choice(choice_samples(F.col("samples")), size, rules.agree_map, rules.agree_portion))
    j = j.withColumn("_f", F.get("candidates", F.col("_v.candidate") - 1))
    label = F.coalesce("labelled", F.lit(False))
    unread = ~label & has_candidates & F.col("samples").isNull()
    taken = ~label & has_candidates & F.col("_v.candidate").isNotNull()
    kind = (F.when(label, "label").when(taken, record_kind(F.col("_f.dataType"), F.col("_f.category"), rules))
            .otherwise("unmapped"))
    package = F.when(F.col("kind") == "product", package_facts(F.coalesce("size", F.lit("")))["package_g"])
    portion = F.when(taken & (F.col("kind") == "menu") & F.col("_v.portion").isNotNull(),
                     F.get("_f.all_portions", F.col("_v.portion") - 1))
    by_package = taken & (F.coalesce(package, F.lit(0.0)) != 0)
    of = lambda c: F.when(taken, F.col(f"_f.{c}"))
    rows = j.filter(~unread).select(
        "id", kind.alias("kind"),
        F.when(label, False).when(taken, (kind == "usda-mixed-dish-estimate") | (F.col("kind") == "menu")).alias("estimate"),
        F.when(~label, F.col("key")).alias("key"), of("fdcId").alias("fdcId"), of("dataType").alias("dataType"),
        of("category").alias("category"), of("description").alias("description"),
        F.when(~label, F.when(has_candidates, F.col("_v.agree")).otherwise(0)).cast("int").alias("agree"),
        F.when(label, F.col("label_g")).when(by_package, package).otherwise(portion["grams"]).alias("grams"),
        F.when(label, "label serving").when(by_package, "package")
        .otherwise(F.concat(F.lit("estimated portion: "), portion["label"])).alias("grams_basis"),
        F.when(~label & ~has_candidates, "no candidate shares a word with the item")
        .when(~label & ~taken, F.col("_v.reason")).alias("reason"))
    return rows, j.filter(unread).select("id", "key", F.lit(NO_MAP).alias("reason"))


def basis_hash(model: Column, battery: Column, sampling: Column) -> Column:
    """Id of the settings readings are kept under."""
    return F.substring(F.sha2(F.to_json(F.struct(battery.alias("battery"), model.alias("model"),
                                                 sampling.alias("sampling"))), 256), 1, 12)
