"""Incident rows to incidents, and incidents to points with counts."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _typed(rows: DataFrame) -> DataFrame:
    """Rows with numeric coordinates; a missing id falls back to the row id, a missing category to Unknown."""
    category = F.col("incident_category")
    return rows.select(
        "row_id",
        F.coalesce(F.nullif(F.col("incident_id").cast("string"), F.lit("")),
                   F.col("row_id").cast("string")).alias("incident"),
        F.when(category.isNull() | (category == ""), "Unknown").otherwise(category).alias("category"),
        F.col("latitude").try_cast("double").alias("lat"),
        F.col("longitude").try_cast("double").alias("lon"),
    ).filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def collapse(rows: DataFrame, buckets: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per incident: first coordinates and 0/1 per bucket it touches."""
    return _typed(rows).groupBy("incident").agg(
        # two numeric picks and not one struct: the buffers then fit a hash aggregate
        F.min_by("lat", "row_id").alias("lat"), F.min_by("lon", "row_id").alias("lon"),
        *[F.max(F.col("category").isin(*members).cast("bigint")).alias(name)
          for name, members in buckets.items()],
    )


def points(incidents: DataFrame, buckets: Sequence[str]) -> DataFrame:
    """Counts per distinct point; additive, since an incident has one point."""
    return incidents.groupBy("lat", "lon").agg(
        *[F.sum(b).alias(b) for b in buckets], F.count(F.lit(1)).alias("all_incidents"))


def category_points(rows: DataFrame) -> DataFrame:
    """Incidents per distinct point and category."""
    per = (_typed(rows).groupBy("incident", "category")
           .agg(F.min(F.struct("row_id", "lat", "lon")).alias("first")))
    at = per.groupBy("incident").agg(F.min("first").alias("at"))
    return (per.select("incident", "category").join(at, "incident")
            .groupBy("at.lat", "at.lon", "category").agg(F.count(F.lit(1)).alias("n")))
