"""Readers of documents, CSV sets and bulk releases.

Positions that decide an order come from the data (``posexplode``) or, for
CSV, from the file, its block and the row within it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.config import FOOD_RELEASES
from larderline.sources import schemas as S


def _documents(spark: SparkSession, path: str, schema: str, pattern: str = "*.json") -> DataFrame:
    """One JSON document per file; the file stem is the slug."""
    return (spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", pattern).json(path)
            .withColumn("slug", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")))


def _listed(spark: SparkSession, path: str, field: str, row: str) -> DataFrame:
    """Rows of a list inside a document, with their position."""
    fields = ",".join(p.strip().replace(" ", ":", 1) for p in row.split(", "))
    doc = spark.read.schema(f"{field} array<struct<{fields}>>").option("multiLine", True).json(path)
    return doc.select(F.posexplode(field).alias("pos", "r")).select("pos", "r.*")


def _placed(rows: DataFrame, name: str = "ord", *columns: Column | str) -> DataFrame:
    """Rows of a scan with their place: file, block and the number of the row, which grows within a block."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    return rows.select(*(columns or ["*"]), place.alias(name))


def poi_elements(spark: SparkSession, path: str) -> DataFrame:
    return _listed(spark, path, "elements", S.ELEMENT)


def poi_base(spark: SparkSession, path: str) -> DataFrame:
    """Citywide rows, JSON arrays; an array is read as one row per element, in order. ``pos`` is (file, block, row)."""
    return _placed(spark.read.schema(S.POI_ROW).option("multiLine", True).json(path), "pos")


def features(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON features with the coordinates kept as text."""
    schema = ("features array<struct<properties:struct<name:string,kind:string,nhood:string>,"
              "geometry:struct<type:string,coordinates:string>>>")
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    return doc.select(F.posexplode("features").alias("pos", "f")).select(
        "pos", "f.properties.name", "f.properties.kind", "f.properties.nhood",
        F.col("f.geometry.type").alias("shape"), F.col("f.geometry.coordinates").alias("coordinates"))


def _points(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))


def polygons(feats: DataFrame) -> DataFrame:
    """(pos, name, rings) of polygons and of each part of multipolygons, in file order."""
    areas = feats.filter(F.col("shape").isin("Polygon", "MultiPolygon") & (F.coalesce("kind", F.lit("")) != "split_line"))
    one = F.array(F.from_json("coordinates", "array<array<array<double>>>"))
    many = F.from_json("coordinates", "array<array<array<array<double>>>>")
    parts = areas.select("pos", "name", F.posexplode(F.when(F.col("shape") == "Polygon", one).otherwise(many)).alias("part", "rings"))
    return parts.select(F.struct("pos", "part").alias("pos"), "name", F.transform("rings", _points).alias("rings"))


def split_line(feats: DataFrame) -> DataFrame:
    """The split line as one row (line), west to east."""
    return feats.filter((F.col("kind") == "split_line")).select(
        _points(F.from_json("coordinates", "array<array<double>>")).alias("line"))


def keep_areas(feats: DataFrame, names: list[str]) -> DataFrame:
    """City polygons by name, with the properties the index uses."""
    return (feats.filter(F.col("nhood").isin(*names)).withColumn("name", F.col("nhood"))
            .withColumn("kind", F.lit("analysis_neighborhood")))


def overlay(spark: SparkSession, path: str) -> DataFrame:
    """Overlay entries: (place, pos, fields)."""
    entry = "struct<" + ",".join(f.strip().replace(" ", ":") for f in S.OVERLAY_FIELDS.split(",")) + ">"
    doc = spark.read.schema(f"overrides map<string,{entry}>").option("multiLine", True).json(path)
    return doc.select(F.posexplode(F.map_entries("overrides")).alias("pos", "e")).select(
        F.col("e.key").alias("place"), "pos", "e.value.*")


def extras(spark: SparkSession, path: str) -> DataFrame:
    return _listed(spark, path, "extras", S.EXTRA)


def incidents(spark: SparkSession, path: str) -> DataFrame:
    return _listed(spark, path, "rows", S.INCIDENT).drop("pos")


def incident_pull(spark: SparkSession, path: str) -> DataFrame:
    """Provenance of a saved pull: boxes, window and time of the pull."""
    schema = ("source string, endpoint string, poi_bbox array<double>, pull_bbox array<double>, pull_pad_m double, "
              "fetched_at string, window_start string")
    return spark.read.schema(schema).option("multiLine", True).json(path)


def csv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, all text; ``ord`` is the order of the rows in their file."""
    rows = (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').option("enforceSchema", False).csv(path))
    return _placed(rows)


def scored_inspections(spark: SparkSession, path: str) -> DataFrame:
    return csv_rows(spark, path, S.SCORED)


def placard_inspections(spark: SparkSession, path: str) -> DataFrame:
    return csv_rows(spark, path, S.PLACARD)


def current_inspections(spark: SparkSession, path: str) -> DataFrame:
    return csv_rows(spark, path, S.CURRENT)


def dataset_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.PROFILE).option("multiLine", True).json(path)


def menus(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Menu documents of a folder, the index file left out."""
    return _documents(spark, path, S.MENU, pattern).filter(F.col("slug") != "index")


def product_lists(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    return _documents(spark, path, S.PRODUCTS, pattern)


def document_texts(spark: SparkSession, path: str) -> DataFrame:
    """Documents as text: (file, doc), for checks of the exact shape."""
    return (spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(path)
            .select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("doc")))


def bulk(spark: SparkSession, path: str, table: str, releases=tuple(FOOD_RELEASES)) -> DataFrame:
    """One table of the bulk releases below ``path``, all text, with release and row order.

    Releases carry different columns; each is read by its own header and the
    wanted columns are taken by name, null where a release has none. A release
    without the table (the two category tables) is left out.
    """
    wanted = [f.split()[0] for f in S.BULK[table].split(", ")]
    out = None
    for release in releases:
        try:
            rows = (spark.read.option("header", True).option("recursiveFileLookup", True).option("escape", '"')
                    .option("multiLine", True).option("pathGlobFilter", f"{table}.csv").csv(f"{path}/{release}"))
        except AnalysisException as e:
            if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # no such file in this release
                continue
            raise
        part = rows.select(
            F.lit(release).alias("release"),
            F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row")).alias("ord"),
            *[F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in wanted])
        out = part if out is None else out.unionByName(part)
    return out


def food_categories(spark: SparkSession, path: str) -> DataFrame:
    """Both category tables as (release, id, description)."""
    plain = bulk(spark, path, "food_category").select("release", "id", "description")
    survey = bulk(spark, path, "wweia_food_category").select(
        "release", F.col("wweia_food_category").alias("id"), F.col("wweia_food_category_description").alias("description"))
    return plain.unionByName(survey)


def tag_readings(spark: SparkSession, path: str) -> DataFrame:
    return _readings(spark, path, S.TAG_READING)


def map_readings(spark: SparkSession, path: str) -> DataFrame:
    return _readings(spark, path, S.MAP_READING)


def _readings(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are dropped, ``ord`` is the line order for last-line-wins."""
    rows = spark.read.schema(schema).json(path).filter(F.col("key").isNotNull())
    return _placed(rows)


def food_records(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Records, one a file; a file may also hold an array of them."""
    return _documents(spark, path, S.RECORD, pattern)


def labels(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    return _documents(spark, path, S.LABEL, pattern).drop("slug")


def grocery_foods(spark: SparkSession, path: str) -> DataFrame:
    return _listed(spark, path, "rows", S.GROCERY).drop("pos")
