"""Menus and product lists to one item table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.config import PackageRules, PriceLevels
from larderline.functions.numbers import round_even
from larderline.functions.text import short_number, slug, squeeze
from larderline.operators.dedup import suffix_ids
from larderline.operators.ordering import ROWS_PER_TASK, first_rows, ordered_position

ITEM_FIELDS = ("id", "place", "kind", "section", "name", "description", "size", "price", "source", "as_of", "status")


def package_facts(size: Column, rules: PackageRules = PackageRules()) -> Column:
    """(sold_by, package_g, package_ml, units) of a printed size such as ``16 Oz``; null when unread."""
    pattern = r"(?i)^\s*([\d.]+)\s*([a-z ]+?)\s*$"
    n = F.regexp_extract(size, pattern, 1).try_cast("double")
    unit = F.lower(F.regexp_extract(size, pattern, 2))

    def factor(table) -> Column:
        return F.create_map(*[F.lit(x) for u, f in table.items() for x in (u, float(f))])[unit]

    grams, ml, pieces = factor(rules.grams), factor(rules.millilitres), factor(rules.pieces)
    read = n.isNotNull()
    return F.struct(
        F.when(read & grams.isNotNull(), "weight").when(read & ml.isNotNull(), "volume")
        .when(read & pieces.isNotNull(), F.when(unit == "each", "each").otherwise("count")).alias("sold_by"),
        round_even(n * grams, 1).alias("package_g"), round_even(n * ml, 1).alias("package_ml"),
        round_even(n * pieces).cast("int").alias("units"))


def with_package_facts(products: DataFrame) -> DataFrame:
    """Products with their size facts; also re-derives them on an existing list."""
    facts = ["sold_by", "package_g", "package_ml", "units"]
    return (products.drop(*facts).withColumn("_f", package_facts(F.coalesce("size", F.lit(""))))
            .select("*", *[f"_f.{c}" for c in facts]).drop("_f"))


def products_from_pull(pull: DataFrame, rules: PackageRules = PackageRules()) -> DataFrame:
    """Store feed rows (ord, sku, title, price, quantity, unit, path) to food products, one per sku."""
    rows = pull.withColumn("path", squeeze(F.col("path")))
    for prefix in rules.non_food:
        rows = rows.filter(~F.col("path").startswith(prefix))
    rows = first_rows(rows, ["sku"], [F.asc("ord")])
    section = F.coalesce(F.nullif(F.regexp_replace("path", "^Food>", ""), F.lit("")), F.lit("Uncategorized"))
    size = squeeze(F.concat_ws(" ", short_number(F.col("quantity")), F.coalesce("unit", F.lit(""))))
    return with_package_facts(rows.select(
        F.replace(section, F.lit(">"), F.lit(" / ")).alias("section"), squeeze(F.col("title")).alias("name"),
        F.lit("").alias("description"), size.alias("size"),
        F.nullif(F.col("price").cast("string"), F.lit("")).try_cast("double").alias("price")))


def in_shelf_order(products: DataFrame) -> DataFrame:
    return products.orderBy("section", "name", "size")


def menu_items(documents: DataFrame) -> DataFrame:
    """Rows of menu documents (name, source, as_of, status, items)."""
    blank = F.lit("")
    return documents.select("name", "source", "as_of", "status", F.posexplode("items").alias("pos", "i")).select(
        F.col("name").alias("place"), F.lit("menu").alias("kind"), F.coalesce("i.section", blank).alias("section"),
        F.col("i.item").alias("name"), F.coalesce("i.description", blank).alias("description"),
        blank.alias("size"), F.col("i.price").alias("price"), "source", "as_of", "status", "pos")


def product_items(documents: DataFrame) -> DataFrame:
    """Rows of product documents (name, source, as_of, status, products)."""
    blank = F.lit("")
    return documents.select("name", "source", "as_of", "status", F.posexplode("products").alias("pos", "i")).select(
        F.col("name").alias("place"), F.lit("product").alias("kind"), F.coalesce("i.section", blank).alias("section"),
        F.col("i.name").alias("name"), F.coalesce("i.description", blank).alias("description"),
        F.coalesce("i.size", blank).alias("size"), F.col("i.price").alias("price"), "source", "as_of", "status", "pos")


def with_ids(rows: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Stable ids: slug of the place and the name, suffixed in (section, description, size, price, name) order.

    Rows equal in all of these are told apart by source and position.
    """
    based = (rows.withColumn("_base", F.concat_ws("--", slug(F.col("place")), slug(F.col("name"))))
             .withColumn("_price", F.coalesce("price", F.lit(-1.0))))
    order = ["section", "description", "size", "_price", "name", "kind", "source", "pos"]
    return suffix_ids(based, "_base", order, "id", rows_per_task).select(*ITEM_FIELDS)


def manifest(documents: DataFrame) -> DataFrame:
    """One entry per document with its number of items."""
    return documents.select("name", "slug", "status", "menu_url", F.coalesce(F.size("items"), F.lit(0)).alias("items_count"),
                            "source", "as_of")


def manifest_from_rows(documents: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Documents with the number of item rows that carry their key."""
    n = items.groupBy(key).agg(F.count(F.lit(1)).alias("items_count"))
    return documents.join(n, key, "left").withColumn("items_count", F.coalesce("items_count", F.lit(0)))


def median_price(items: DataFrame, place: str, price: str, unique: str,
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Exact median price per place, from positions in the price order."""
    priced = items.filter(F.col(price).isNotNull()).select(place, price, unique)
    placed = ordered_position(priced, [place], [price, unique], "_pos", rows_per_task)
    n = priced.groupBy(place).agg(F.count(F.lit(1)).alias("_n"))
    middle = (F.col("_pos") == F.floor((F.col("_n") + 1) / 2)) | (F.col("_pos") == F.floor(F.col("_n") / 2) + 1)
    return placed.join(n, place).filter(middle).groupBy(place).agg(F.avg(price).alias("median_price"))


def price_level(median: Column, levels: PriceLevels = PriceLevels()) -> Column:
    out = F.when(median.isNull(), None)
    for n, limit in enumerate(levels.below, 1):
        out = out.when(median < limit, n)
    return out.otherwise(len(levels.below) + 1)


def local_date(instant: Column, zone: str) -> Column:
    """Calendar date of an instant (ISO text with offset) in a time zone."""
    return F.to_date(F.from_utc_timestamp(F.to_utc_timestamp(F.to_timestamp(instant), F.current_timezone()), zone))
