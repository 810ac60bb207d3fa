"""Counts, profiles and comparisons over the built tables."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.config import PlaceRules


def with_total(df: DataFrame, by: str, measures: Sequence[Column], total: str = "TOTAL") -> DataFrame:
    """Measures per group and over all rows, in one pass."""
    return (df.groupingSets([[by], []], by).agg(F.grouping(by).alias("_all"), *measures)
            .withColumn(by, F.when(F.col("_all") == 1, total).otherwise(F.col(by))).drop("_all"))


def coverage(places: DataFrame, statuses: Sequence[str] = ("ok", "partial", "not_found", "skipped")) -> DataFrame:
    """Places, categories, walk range and layers per neighborhood, plus TOTAL.

    places: neighborhood, category, walkMin, has_risk, match_confidence (null
    without inspections), menu_status (null when not tried).
    """
    named = places.withColumn("neighborhood", F.coalesce("neighborhood", F.lit("(none)")))
    return with_total(named, "neighborhood", [
        F.count(F.lit(1)).alias("places"),
        *[F.count_if(F.col("category") == c).alias(c) for c in ("restaurant", "cafe", "grocery")],
        F.min("walkMin").alias("walk_min"), F.max("walkMin").alias("walk_max"),
        F.count_if("has_risk").alias("with_risk"),
        F.count_if(F.col("match_confidence").isNotNull()).alias("with_inspection"),
        F.count_if(F.col("match_confidence") == "name+address").alias("with_address_match"),
        F.count_if(F.col("menu_status").isNotNull()).alias("menus_tried"),
        *[F.count_if(F.col("menu_status") == s).alias(s) for s in statuses]])


def in_display_order(rows: DataFrame, by: str, rules: PlaceRules = PlaceRules()) -> DataFrame:
    """Fixed areas first, the rest by name, the total last."""
    place = F.array_position(F.array(*[F.lit(n) for n in rules.display_order]), F.col(by))
    return rows.orderBy(F.col(by) == "TOTAL", F.when(place > 0, place).otherwise(len(rules.display_order) + 1), by)


def menu_coverage(places: DataFrame) -> DataFrame:
    """Restaurants and cafes: all, with a menu, attempted."""
    return places.filter(F.col("category").isin("restaurant", "cafe")).agg(
        F.count(F.lit(1)).alias("places"), F.count_if(F.col("menu_status").isin("ok", "partial")).alias("with_menu"),
        F.count_if(F.col("menu_status").isNotNull()).alias("attempted"))


def area_summary(places: DataFrame) -> DataFrame:
    """Size, longest walk and layers per neighborhood, largest first."""
    return places.groupBy("neighborhood").agg(
        F.count(F.lit(1)).alias("places"), F.max("walkMin").alias("walk_max"),
        *[F.count_if(c).alias(c) for c in ("has_menu", "has_inspection", "has_risk")]).orderBy(F.desc("places"))


def menu_report(documents: DataFrame) -> DataFrame:
    """Per status: documents, items, priced items, date range. documents: status, as_of, items, priced."""
    return with_total(documents, "status", [
        F.count(F.lit(1)).alias("documents"), F.sum("items").alias("items"), F.sum("priced").alias("priced"),
        F.min("as_of").alias("first_as_of"), F.max("as_of").alias("last_as_of")])


def level_report(documents: DataFrame, level: str) -> DataFrame:
    return documents.filter(F.col(level).isNotNull()).groupBy(level).agg(F.count(F.lit(1)).alias("documents"))


def poi_report(rows: DataFrame) -> DataFrame:
    """Per category and in total: rows, named, with website, with address."""
    has = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    return with_total(rows, "category", [F.count(F.lit(1)).alias("n"), has("name").alias("named"),
                                         has("website").alias("website"), has("addr").alias("addr")])


def subtype_report(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category", "subtype").agg(F.count(F.lit(1)).alias("n")).orderBy("category", F.desc("n"))


def dataset_profile(rows: DataFrame, dataset: str, day: Column, today: str) -> DataFrame:
    """Rows, first and last day, last day not after today, rows dated later. Days as text."""
    d = F.nullif(F.substring(day, 1, 10), F.lit(""))
    return rows.select(d.alias("d")).agg(
        F.lit(dataset).alias("dataset"), F.count(F.lit(1)).alias("rows"), F.min("d").alias("date_min"),
        F.max("d").alias("date_max"), F.max(F.when(F.col("d") <= today, F.col("d"))).alias("date_max_not_after_today"),
        F.count_if(F.col("d") > today).alias("future_dated_rows"))


def dataset_range(profiles: DataFrame) -> DataFrame:
    return profiles.agg(F.min("date_min").alias("date_min"), F.max("date_max_not_after_today").alias("date_max"))


def agreement(left: DataFrame, right: DataFrame, keys: Sequence[str], answer: str) -> DataFrame:
    """Pairs of answers of two label sets and how often each occurs; an absent right answer is null."""
    j = left.select(*keys, F.col(answer).alias("pinned")).join(
        right.select(*keys, F.col(answer).alias("other")), list(keys), "left")
    return j.groupBy("pinned", "other").agg(F.count(F.lit(1)).alias("n"))


def agreement_rate(confusion: DataFrame) -> DataFrame:
    same = F.col("pinned").eqNullSafe(F.col("other"))
    return confusion.agg(F.sum(F.when(same, F.col("n")).otherwise(0)).alias("same"), F.sum("n").alias("total")) \
        .withColumn("rate", F.col("same") / F.col("total"))


def map_agreement(left: DataFrame, right: DataFrame) -> DataFrame:
    """Items of two food maps that name the same kind and record."""
    r = right.select("id", F.col("kind").alias("r_kind"), F.col("fdcId").alias("r_fdcId"))
    return left.join(r, "id").agg(
        F.count_if(F.col("kind").eqNullSafe(F.col("r_kind")) & F.col("fdcId").eqNullSafe(F.col("r_fdcId"))).alias("same"),
        F.count(F.lit(1)).alias("total"))


def usage_cost(usage: DataFrame, prices: DataFrame, by: str, discount: float = 0.5) -> DataFrame:
    """Tokens and cost per group. usage: input, cache_write, cache_read, output; prices per million tokens."""
    tokens = usage.groupBy(by).agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c)
                                     for c in ("input", "cache_write", "cache_read", "output")])
    # fixed values: a cache write costs a quarter more than input, a cache read a tenth of it
    full = (F.col("input") * F.col("price_in") + F.col("cache_write") * F.col("price_in") * 1.25
            + F.col("cache_read") * F.col("price_in") * 0.1 + F.col("output") * F.col("price_out")) / 1e6
    return tokens.join(prices, by).withColumn("cost", full * discount).drop("price_in", "price_out")


def answer_distribution(tags: DataFrame, answers: Sequence[str] = ("yes", "no", "unknown")) -> DataFrame:
    """Answers per attribute and the share of unknown."""
    counted = tags.groupBy("attribute").agg(
        *[F.count_if(F.col("answer") == a).alias(a) for a in answers], F.count(F.lit(1)).alias("n"))
    return counted.withColumn("unknown_rate", F.col("unknown") / F.col("n"))


def null_counts(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    return rows.agg(*[F.count_if(F.col(f).isNull()).alias(f.split(".")[-1]) for f in fields])


def counts(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by)


def reason_counts(rows: DataFrame) -> DataFrame:
    """Kinds of a food map with the reasons of the unmapped ones."""
    return rows.groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))


def price_table(spark, prices: Mapping[str, tuple[float, float]], by: str = "model") -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in prices.items()], f"{by} string, price_in double, price_out double")
