"""POI elements to place rows: classes, addresses, overlay, filters."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.config import PlaceRules
from larderline.functions.geo import walk_minutes
from larderline.functions.numbers import round_even
from larderline.functions.text import normal_name


def _tag(key: str) -> Column:
    """Tag value; absent and blank are both null."""
    return F.nullif(F.col("tags")[key], F.lit(""))


def local_class() -> Column:
    """(category, subtype): every element that is no restaurant or cafe counts as a grocery."""
    amenity = F.col("tags")["amenity"]
    return (F.when(amenity.isin("restaurant", "fast_food"), F.struct(F.lit("restaurant").alias("category"), amenity.alias("subtype")))
            .when(amenity == "cafe", F.struct(F.lit("cafe").alias("category"), amenity.alias("subtype")))
            .otherwise(F.struct(F.lit("grocery").alias("category"),
                                F.coalesce(F.col("tags")["shop"], F.lit("shop")).alias("subtype"))))


def citywide_class(rules: PlaceRules = PlaceRules()) -> Column:
    """(category, subtype), null outside the listed shops."""
    c = local_class()
    return F.when((c["category"] != "grocery") | F.col("tags")["shop"].isin(*rules.citywide_grocery), c)


def address(full: bool = False) -> Column:
    """House number and street, or the street; the citywide form falls back to the full address."""
    both = F.when(_tag("addr:housenumber").isNotNull() & _tag("addr:street").isNotNull(),
                  F.concat_ws(" ", _tag("addr:housenumber"), _tag("addr:street")))
    parts = [both, _tag("addr:street")] + ([_tag("addr:full")] if full else [])
    return F.coalesce(*parts, F.lit(""))


def located(elements: DataFrame) -> DataFrame:
    """Elements with coordinates, their own or those of their center."""
    return (elements.withColumn("lat", F.coalesce("lat", "center.lat"))
            .withColumn("lon", F.coalesce("lon", "center.lon")).filter(F.col("lat").isNotNull()))


def normalize_elements(elements: DataFrame, rules: PlaceRules = PlaceRules()) -> DataFrame:
    """Citywide base rows: one flat row per listed element."""
    first = located(elements).withColumn("_class", citywide_class(rules)).filter(F.col("_class").isNotNull())
    blank = F.lit("")
    return first.select(
        F.col("type").alias("osm_type"), F.col("id").alias("osm_id"), _tag("name").alias("name"),
        "_class.category", "_class.subtype",
        F.nullif(F.translate(F.col("tags")["cuisine"], "_", " "), blank).alias("cuisine"),
        F.nullif(address(full=True), blank).alias("addr"), _tag("addr:postcode").alias("postal"),
        round_even(F.col("lat"), 6).alias("lat"), round_even(F.col("lon"), 6).alias("lon"),
        F.coalesce(_tag("website"), _tag("contact:website")).alias("website"),
        F.coalesce(_tag("phone"), _tag("contact:phone")).alias("phone"),
        _tag("opening_hours").alias("opening_hours"))


def in_base_order(rows: DataFrame) -> DataFrame:
    """Category, then name without case (none last), then type and id."""
    return rows.orderBy("category", F.lower(F.coalesce("name", F.lit("~"))), "osm_type", "osm_id")


def place_rows(elements: DataFrame, rules: PlaceRules = PlaceRules()) -> DataFrame:
    """Named elements of the local box as place rows, with the element position as order."""
    first = located(elements).filter(_tag("name").isNotNull()).withColumn("_class", local_class())
    keep = (F.col("_class.category") != "grocery") | F.col("_class.subtype").isin(*rules.local_grocery)
    tag = lambda key: F.coalesce(F.col("tags")[key], F.lit(""))
    return first.filter(keep).select(
        "pos", F.col("tags")["name"].alias("name"), "_class.category", "_class.subtype",
        F.translate(tag("cuisine"), "_", " ").alias("cuisine"), address().alias("addr"), "lat", "lon",
        tag("opening_hours").alias("hours"), tag("website").alias("website"), tag("phone").alias("phone"))


def base_place_rows(base: DataFrame) -> DataFrame:
    """Citywide rows as place rows."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return base.filter(F.coalesce("name", F.lit("")) != "").select(
        "pos", "name", "category", "subtype", text("cuisine").alias("cuisine"), text("addr").alias("addr"),
        "lat", "lon", text("opening_hours").alias("hours"), text("website").alias("website"),
        text("phone").alias("phone"))


def with_walk(places: DataFrame, rules: PlaceRules = PlaceRules()) -> DataFrame:
    return places.withColumn("walkMin", walk_minutes(F.col("lat"), F.col("lon"), rules.home,
                                                     rules.metres_per_minute))


def overlay(places: DataFrame, overrides: DataFrame, name: str = "name") -> DataFrame:
    """Overlay fields by normalized name onto every namesake; a present field wins.

    ``overrides`` has the column ``place`` (the name as the overlay spells it)
    and the sparse fields. Where two entries share a normalized name the last
    by ``pos`` is taken.
    """
    fields = [c for c in overrides.columns if c not in ("place", "pos")]
    keyed = (overrides.withColumn("_norm", normal_name(F.col("place")))
             .groupBy("_norm").agg(F.max_by(F.struct(*fields), "pos").alias("_o")))
    out = places.withColumn("_norm", normal_name(F.col(name))).join(keyed, "_norm", "left")
    for f in fields:
        own = F.col(f) if f in places.columns else F.lit(None)
        out = out.withColumn(f, F.coalesce(F.col("_o")[f], own))
    return out.drop("_norm", "_o")


def search(places: DataFrame, text: str | None = None, categories: Sequence[str] = (),
           verdicts: Sequence[str] = (), areas: Sequence[str] = (), curated: bool = False) -> DataFrame:
    """Text, category, verdict and area filters of the place list; ``curated`` keeps noted places."""
    if text:
        places = places.filter(F.contains(F.lower("name"), F.lit(text.lower())))
    for column, wanted in (("category", categories), ("verdict", verdicts), ("neighborhood", areas)):
        if wanted:
            places = places.filter(F.col(column).isin(*wanted))
    return places.filter(F.col("notes").isNotNull()) if curated else places


def in_walk_order(places: DataFrame) -> DataFrame:
    return places.orderBy("walkMin", "name")
