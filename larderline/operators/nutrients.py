"""Food index and nutrient rows from bulk tables; unknown stays null and never zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.config import FOOD_RELEASES, SURVEY, NutrientRules
from larderline.functions.numbers import round_even
from larderline.functions.text import squeeze, strip


def _releases(which: int) -> Column:
    return F.create_map(*[F.lit(x) for rel, types in FOOD_RELEASES.items() for x in (rel, types[which])])


def portion_label(amount: Column, unit: Column, modifier: Column, description: Column) -> Column:
    """``1 cup chopped``: blank parts and an undetermined unit are left out."""
    part = lambda c: F.nullif(strip(c), F.lit(""))
    text = F.concat_ws(" ", part(amount), F.when(unit != "undetermined", part(unit)), part(modifier), part(description))
    return squeeze(text)


def own_foods(food: DataFrame) -> DataFrame:
    """Rows of each release's own data type, with the type the index uses."""
    return (food.filter(F.col("data_type") == _releases(0)[F.col("release")])
            .withColumn("dataType", _releases(1)[F.col("release")]))


def food_portions(foods: DataFrame, portions: DataFrame, units: DataFrame) -> DataFrame:
    """Weighed portions of the foods (see ``own_foods``), one row each: (release, fdc_id, ord, label, grams)."""
    weighed = portions.filter(F.coalesce("gram_weight", F.lit("")) != "").join(
        foods.select("release", "fdc_id", "dataType"), ["release", "fdc_id"])
    named = weighed.join(units.select("release", F.col("id").alias("measure_unit_id"), F.col("name").alias("unit")),
                         ["release", "measure_unit_id"], "left")
    label = portion_label(F.col("amount"), F.coalesce("unit", F.lit("")), F.col("modifier"), F.col("portion_description"))
    own = (F.col("dataType") == SURVEY) & (strip(F.col("portion_description")) != "")
    return named.select("release", "fdc_id", "ord", F.when(own, strip(F.col("portion_description"))).otherwise(label).alias("label"),
                        round_even(F.col("gram_weight").cast("double"), 1).alias("grams"))


def food_index(food: DataFrame, portions: DataFrame, units: DataFrame, categories: DataFrame) -> DataFrame:
    """Foods with category and portions: (fdcId, dataType, description, category, portions).

    All inputs carry ``release``; portions carry ``ord``; categories are
    (release, id, description) of either category table. The list nests the
    household portions of one food, a handful; ``food_portions`` is the same
    as a long table.
    """
    foods = own_foods(food)
    listed = food_portions(foods, portions, units).groupBy("release", "fdc_id").agg(
        F.array_sort(F.collect_list(F.struct("ord", "label", "grams"))).alias("p"))
    return (
        foods.join(listed, ["release", "fdc_id"], "left")
        .join(categories.select("release", F.col("id").alias("food_category_id"), F.col("description").alias("category")),
              ["release", "food_category_id"], "left")
        .select(F.col("fdc_id").cast("bigint").alias("fdcId"), "dataType", "description",
                F.coalesce("category", F.lit("")).alias("category"),
                F.coalesce(F.transform("p", lambda x: F.struct(x["label"].alias("label"), x["grams"].alias("grams"))),
                           F.array().cast("array<struct<label:string,grams:double>>")).alias("portions")))


def flatten_records(records: DataFrame, fetched_at: str) -> DataFrame:
    """Service records to cached ones: nutrients with an id and an amount, by id; portions with a weight."""
    kept = F.filter("foodNutrients", lambda n: n["amount"].isNotNull() & F.coalesce(n["nutrient"]["id"] != 0, F.lit(False)))
    nutrients = F.array_sort(F.transform(kept, lambda n: F.struct(
        n["nutrient"]["id"].alias("id"), n["nutrient"]["number"].alias("number"), n["nutrient"]["name"].alias("name"),
        n["nutrient"]["unitName"].alias("unit"), n["amount"].alias("amount"))))
    amount = lambda p: F.when(p["amount"] != 0, F.format_string("%s", p["amount"]))
    label = lambda p: portion_label(amount(p), F.coalesce(p["measureUnit"]["name"], F.lit("")),
                                    p["modifier"], p["portionDescription"])
    portions = F.transform(
        F.filter("foodPortions", lambda p: F.coalesce(p["gramWeight"] != 0, F.lit(False))),
        lambda p: F.struct(F.when(F.col("dataType") == SURVEY, strip(F.coalesce(p["portionDescription"], F.lit(""))))
                           .otherwise(label(p)).alias("description"), p["gramWeight"].alias("gram_weight")))
    none = lambda t: F.array().cast(t)
    return records.select(
        "fdcId", "dataType", "description", "publicationDate", F.lit(fetched_at).alias("fetched_at"),
        F.coalesce(nutrients, none("array<struct<id:int,number:string,name:string,unit:string,amount:double>>")).alias("nutrients"),
        F.coalesce(portions, none("array<struct<description:string,gram_weight:double>>")).alias("portions"))


def resolve_codes(amounts: DataFrame, nutrient: DataFrame, rules: NutrientRules = NutrientRules()) -> DataFrame:
    """Amount rows with the wanted nutrient id.

    A code under four digits is a number and stands, per release, for the
    wanted id that comes first in its field's fallback.
    """
    rank = [(i, pos) for ids in rules.fields.values() for pos, i in enumerate(ids)]
    ranks = F.create_map(*[F.lit(x) for pair in rank for x in pair])
    wanted = [i for i, _ in rank]
    number = lambda c: F.col(c).try_cast("double").cast("bigint").cast("string")
    nid = F.col("id").cast("int")
    table = (nutrient.filter(nid.isin(*wanted) & (F.coalesce("nutrient_nbr", F.lit("")) != ""))
             .groupBy("release", number("nutrient_nbr").alias("_number"))
             .agg(F.min_by(nid, ranks[nid]).alias("_by_number")))
    code = amounts.withColumn("_number", number("nutrient_id"))
    found = code.join(table, ["release", "_number"], "left")
    return (found.withColumn("nid", F.when(F.length("_number") >= 4, F.col("_number").cast("int"))
                             .otherwise(F.col("_by_number")))
            .filter(F.col("nid").isin(*wanted)).drop("_number", "_by_number"))


def nutrient_rows(amounts: DataFrame, food: str, nid: str, amount: str, order: str,
                  rules: NutrientRules = NutrientRules()) -> DataFrame:
    """Per food: each field's first reported value and the id it came from.

    The last row of an id counts; blank is not reported, zero is.
    """
    ids = [i for field in rules.fields.values() for i in field]
    last = amounts.filter(F.col(nid).isin(*ids)).groupBy(food).agg(
        *[F.max(F.when(F.col(nid) == i, F.struct(order, amount)))[amount].alias(f"n{i}") for i in ids])
    value = lambda i: F.nullif(F.col(f"n{i}").cast("string"), F.lit("")).try_cast("double")
    per, used = [], []
    for field, order_ids in rules.fields.items():
        per.append(F.coalesce(*[value(i) for i in order_ids]).alias(field))
        hit = F.when(value(order_ids[0]).isNotNull(), order_ids[0])
        for i in order_ids[1:]:
            hit = hit.when(value(i).isNotNull(), i)
        used.append(hit.alias(field))
    return last.select(food, F.struct(*per).alias("per_100g"), F.struct(*used).alias("nutrient_ids"))


def nutrients_for(foods: DataFrame, rows: DataFrame, rules: NutrientRules = NutrientRules()) -> DataFrame:
    """Foods with their nutrient row; a food without amounts carries nulls in every field."""
    return foods.join(rows, "fdcId", "left")


def item_amounts(mapped: DataFrame, nutrients: DataFrame, grams: str = "grams",
                 rules: NutrientRules = NutrientRules()) -> DataFrame:
    """Amount of each field in an item: per 100 g times grams over 100; null stays null."""
    joined = mapped.join(nutrients.select("fdcId", "per_100g"), "fdcId", "left")
    return joined.withColumns({f: F.col(f"per_100g.{f}") * F.col(grams) / 100 for f in rules.fields}).drop("per_100g")


def label_amounts(labels: DataFrame) -> DataFrame:
    """Amounts of labelled items as printed per serving, one row per nutrient; unlisted ones are unknown."""
    return labels.select("id", "serving_g", F.explode("nutrients").alias("n")).select(
        "id", "serving_g", "n.name", "n.unit", "n.amount")


def amounts_of_items(food_map: DataFrame, nutrients: DataFrame, labels: DataFrame, rules: NutrientRules = NutrientRules()) -> DataFrame:
    """Amounts of every mapped item, one row per nutrient: (id, basis, name, amount).

    A labelled item has what its label prints, per serving, and nothing else; another has each field of its record per
    100 g times its grams over 100, null where the record, the grams or the field is unknown.
    """
    printed = (food_map.filter("kind = 'label'").select("id").join(label_amounts(labels), "id")
               .select("id", F.lit("label").alias("basis"), "name", F.col("amount").cast("double").alias("amount")))
    fields = F.array(*[F.struct(F.lit(f).alias("name"), F.col(f).alias("amount")) for f in rules.fields])
    of_record = item_amounts(food_map.filter("kind <> 'label'"), nutrients, rules=rules).select("id", F.lit("record").alias("basis"), F.inline(fields))
    return printed.unionByName(of_record)


def mapped_records(food_map: DataFrame, grocery: DataFrame) -> DataFrame:
    """Every record a mapping uses."""
    return (food_map.select("fdcId").union(grocery.select("fdcId"))
            .filter(F.col("fdcId").isNotNull()).distinct())


def missing_records(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    return wanted.select("fdcId").distinct().join(cached.select("fdcId"), "fdcId", "left_anti")


def content_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """Digest of a row set that does not depend on order or partitioning.

    Each row is hashed, and the hashes are added in four limbs; sums combine
    on the map side. It is not the digest of one text over all rows.
    """
    row = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)
    limb = lambda i: F.conv(F.substring("_h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")
    sums = df.select(row.alias("_h")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(limb(i)).alias(f"s{i}") for i in range(4)])
    text = F.concat_ws("-", F.col("rows").cast("string"),
                       *[F.coalesce(F.col(f"s{i}"), F.lit(0)).cast("string") for i in range(4)])
    return sums.select("rows", F.sha2(text, 256).alias("digest"))
