"""Place index: union of sources, labels, greedy duplicate removal, overlay and layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.config import PlaceRules
from larderline.functions.numbers import round_even
from larderline.functions.text import normal_name
from larderline.operators.dedup import keep_distinct_places, place_key
from larderline.operators.places import base_place_rows, overlay, place_rows, with_walk
from larderline.operators.spatial import label_points, relabel_north_of
from larderline.session import cut


def labelled(points: DataFrame, polygons: DataFrame, line: DataFrame | None, rules: PlaceRules) -> DataFrame:
    out = label_points(points, polygons, "neighborhood")
    if line is not None:
        out = relabel_north_of(out, line, "neighborhood", rules.split_names, rules.split_label)
    return out


def build(elements: DataFrame, extras: DataFrame, base: DataFrame, overrides: DataFrame, polygons: DataFrame,
          line: DataFrame | None = None, rules: PlaceRules = PlaceRules()) -> DataFrame:
    """Places from the local box, the curated extras and the citywide base, in that order.

    A row near an earlier namesake is dropped, except an extra: it stays and
    then carries the bare name, which the key check reports.
    """
    def ordered(df: DataFrame, n: int) -> DataFrame:
        """Rows with their place: the source, then the row's place in its file."""
        pos = F.col("pos")
        if not isinstance(df.schema["pos"].dataType, T.StructType):  # a place in one list
            pos = F.struct(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"), pos.cast("bigint").alias("row"))
        return df.withColumn("seq", F.struct(F.lit(n).alias("source"), pos.alias("pos"))).drop("pos")

    local = ordered(place_rows(elements, rules), 0)
    added = ordered(extras, 1)
    city = ordered(base_place_rows(base), 2)
    rows = local.unionByName(added, allowMissingColumns=True).unionByName(city, allowMissingColumns=True)
    rows = labelled(rows, polygons, line, rules)
    rows = cut(rows.filter((F.col("seq.source") != 2) | F.col("neighborhood").isin(*rules.expansion)))

    kept = keep_distinct_places(rows, normal_name(F.col("name")), "seq", rules.duplicate_m)
    lost = (rows.filter(F.col("seq.source") == 1).join(kept.select("seq"), "seq", "left_anti")
            .withColumn("first_of_name", F.lit(True)))
    placed = with_walk(kept.unionByName(lost), rules).withColumn("key", place_key(
        F.col("name"), F.col("addr"), F.col("lat"), F.col("lon"), F.col("first_of_name")))
    # extras carry their own curated fields and their exact point
    curated = placed.filter(F.col("seq.source") == 1)
    others = overlay(placed.filter(F.col("seq.source") != 1), overrides)
    others = others.withColumn("lat", round_even(F.col("lat"), 5)).withColumn("lon", round_even(F.col("lon"), 5))
    return others.unionByName(curated, allowMissingColumns=True).drop("first_of_name")


RISK_FIELDS = ("violent", "property", "drug", "total", "per_month", "percentile", "nearest_incident_m")
INSPECTION_FIELDS = ("last_score", "last_score_date", "last_inspection_date", "last_inspection_type",
                     "violation_count_last", "last_status", "last_status_date", "closures_all_time",
                     "conditional_pass_all_time", "high_risk_count_all_time", "worst_score_all_time",
                     "inspections_total", "match_confidence", "dataset_range")


def _layer(places: DataFrame, layer: DataFrame, fields, name: str) -> DataFrame:
    slim = layer.select("key", F.struct(*[F.col(f) for f in fields if f in layer.columns]).alias(name))
    return places.join(slim, "key", "left")


def merge_layers(places: DataFrame, risk: DataFrame | None = None, inspections: DataFrame | None = None,
                 menus: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """Layers by key, as structs; a product list replaces a menu.

    Inspections count when their match is not none, menus when ok or partial.
    menus: name, menu_url, items_count, status, slug; products the same with
    source_url.
    """
    out = places
    if risk is not None:
        out = _layer(out, risk, RISK_FIELDS, "risk")
    if inspections is not None:
        out = _layer(out, inspections.filter(F.col("match_confidence") != "none"), INSPECTION_FIELDS, "inspection")
    entry = lambda df, url, kind: df.select(
        F.col("name").alias("key"), F.struct(F.col(url).alias("url"), F.col("items_count").alias("items"), "status", "slug",
                                             F.lit(kind).alias("kind")).alias(f"_{kind}"))
    if menus is not None:
        out = out.join(entry(menus.filter(F.col("status").isin("ok", "partial")), "menu_url", "menu"), "key", "left")
    if products is not None:
        out = out.join(entry(products, "source_url", "products"), "key", "left")
    parts = [c for c in ("_products", "_menu") if c in out.columns]
    if parts:
        out = out.withColumn("menu_data", F.coalesce(*parts)).drop(*parts)
    return out


def with_extra_points(places: DataFrame, extras: DataFrame) -> DataFrame:
    """Coordinates for places without, from the extras by name."""
    e = extras.select("name", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    return (places.join(e, "name", "left").withColumn("lon", F.when(F.col("lat").isNull(), F.col("_lon")).otherwise(F.col("lon")))
            .withColumn("lat", F.coalesce("lat", "_lat")).drop("_lat", "_lon"))
