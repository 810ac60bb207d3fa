"""Food index and nutrient table from the bulk releases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.config import NutrientRules
from larderline.operators import nutrients as N
from larderline.sources import readers


def index(spark: SparkSession, path: str) -> DataFrame:
    return N.food_index(readers.bulk(spark, path, "food"), readers.bulk(spark, path, "food_portion"),
                        readers.bulk(spark, path, "measure_unit"), readers.food_categories(spark, path))


def table(spark: SparkSession, path: str, mapped: DataFrame, rules: NutrientRules = NutrientRules()) -> DataFrame:
    """One row per mapped record: (fdcId, dataType, description, per_100g, nutrient_ids)."""
    food = N.own_foods(readers.bulk(spark, path, "food"))
    foods = food.select(F.col("fdc_id").cast("bigint").alias("fdcId"), "dataType", "description").join(
        mapped.select("fdcId"), "fdcId", "left_semi")
    amounts = readers.bulk(spark, path, "food_nutrient").withColumn("fdcId", F.col("fdc_id").cast("bigint")).join(
        mapped.select("fdcId"), "fdcId", "left_semi")
    resolved = N.resolve_codes(amounts, readers.bulk(spark, path, "nutrient"), rules)
    return N.nutrients_for(foods, N.nutrient_rows(resolved, "fdcId", "nid", "amount", "ord", rules), rules)


def digest(rows: DataFrame) -> DataFrame:
    return N.content_digest(rows, rows.columns)
