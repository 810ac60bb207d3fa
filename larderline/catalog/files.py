"""Documents and files of every source, written from the tables and read back by the library's readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larderline.catalog.base import Registry, point, point_sql, table
from larderline.session import fresh_path
from larderline.sources import readers, writers

REGISTRY = Registry()
ROWS = 50  # rows of a document that holds a list, or a part of it


def put(spark, docs: DataFrame, name: str) -> str:
    """One file for each row of ``docs`` (doc)."""
    path = fresh_path(spark, name)
    docs.select(F.col("doc").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


def lists(rows: DataFrame, key: str, row: Column, field: str | None) -> DataFrame:
    """Documents with the list of at most ``ROWS`` neighbouring rows, alone or under a field."""
    grouped = rows.groupBy(F.floor(F.col(key) / ROWS).alias("g")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), row.alias("r")))), lambda x: x["r"]).alias("rows"))
    return grouped.select(F.to_json(F.struct(F.col("rows").alias(field)) if field else F.col("rows")).alias("doc"))


@REGISTRY.add("poi_file", f"""
SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'way' ELSE 'node' END AS type, s_suppkey AS id, CASE WHEN s_suppkey % 3 <> 0 THEN lat END AS lat, CASE WHEN s_suppkey % 3 = 0 THEN lat END AS center_lat,
  s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN 'cafe' END AS amenity, (row_number() OVER (PARTITION BY s_suppkey // 50 ORDER BY s_suppkey) - 1)::INT AS pos
FROM (SELECT *, {point_sql('s_suppkey')} FROM supplier)""")
def poi_file(spark, sf):
    """Points of interest as documents of elements: nodes with a point, ways with a centre."""
    k, (lat, lon) = F.col("s_suppkey"), point("s_suppkey")
    way = k % 3 == 0
    element = F.struct(F.when(way, "way").otherwise("node").alias("type"), k.alias("id"), F.when(~way, lat).alias("lat"), F.when(~way, lon).alias("lon"),
                       F.when(way, F.struct(lat.alias("lat"), lon.alias("lon"))).alias("center"),
                       F.struct(F.col("s_name").alias("name"), F.when(k % 4 == 0, "cafe").alias("amenity")).alias("tags"))
    found = readers.poi_elements(spark, put(spark, lists(table(spark, sf, "supplier"), "s_suppkey", element, "elements"), "elements"))
    return found.select("type", "id", "lat", F.col("center.lat").alias("center_lat"), F.col("tags")["name"].alias("name"), F.col("tags")["amenity"].alias("amenity"), "pos")


@REGISTRY.add("poi_base_file", f"""
SELECT c_custkey AS osm_id, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'cafe' ELSE 'grocery' END AS category, lat, lon, row_number() OVER (PARTITION BY c_custkey // 50 ORDER BY c_custkey) AS n
FROM (SELECT *, {point_sql('c_custkey')} FROM customer)""")
def poi_base_file(spark, sf):
    """Citywide rows as arrays; their position is that within their file."""
    k, (lat, lon) = F.col("c_custkey"), point("c_custkey")
    row = F.struct(F.lit("node").alias("osm_type"), k.alias("osm_id"), F.col("c_name").alias("name"), F.when(k % 2 == 0, "cafe").otherwise("grocery").alias("category"), lat.alias("lat"), lon.alias("lon"))
    found = readers.poi_base(spark, put(spark, lists(table(spark, sf, "customer"), "c_custkey", row, None), "base"))
    n = F.row_number().over(Window.partitionBy("pos.file").orderBy("pos"))  # a file holds a bounded list
    return found.select("osm_id", "name", "category", "lat", "lon", n.alias("n"))


@REGISTRY.add("overlay_file", """
SELECT 'place ' || p_partkey AS place, (p_partkey % 4 + 1)::INT AS price, CASE WHEN p_partkey % 3 = 0 THEN 'ok' END AS verdict, p_partkey % 2 = 0 AS laptops FROM part""")
def overlay_file(spark, sf):
    """Overlay documents: a map of places with the fields that override."""
    k = F.col("p_partkey")
    entry = F.struct((k % 4 + 1).cast("int").alias("price"), F.when(k % 3 == 0, "ok").alias("verdict"), (k % 2 == 0).alias("laptops"))
    pair = F.struct(F.concat(F.lit("place "), k.cast("string")).alias("key"), entry.alias("value"))
    docs = table(spark, sf, "part").groupBy(F.floor(k / ROWS).alias("g")).agg(F.map_from_entries(F.collect_list(pair)).alias("overrides")).select(F.to_json(F.struct("overrides")).alias("doc"))
    return readers.overlay(spark, put(spark, docs, "overlay")).select("place", "price", "verdict", "laptops")


@REGISTRY.add("extras_file", f"""
SELECT s_name AS name, 'cafe' AS category, lat, lon, (s_suppkey % 4)::INT AS price FROM (SELECT *, {point_sql('s_suppkey')} FROM supplier)""")
def extras_file(spark, sf):
    k, (lat, lon) = F.col("s_suppkey"), point("s_suppkey")
    row = F.struct(F.col("s_name").alias("name"), F.lit("cafe").alias("category"), lat.alias("lat"), lon.alias("lon"), (k % 4).cast("int").alias("price"))
    return readers.extras(spark, put(spark, lists(table(spark, sf, "supplier"), "s_suppkey", row, "extras"), "extras")).select("name", "category", "lat", "lon", "price")


@REGISTRY.add("incident_file", """
SELECT event_id::VARCHAR AS row_id, CASE WHEN event_id % 5 <> 0 THEN (event_id // 3)::VARCHAR END AS incident_id, event_type AS incident_category, CASE WHEN event_id % 7 <> 0 THEN '37.75' END AS latitude FROM events""")
def incident_file(spark, sf):
    """Saved pulls of incident rows, some without id or point."""
    k = F.col("event_id")
    row = F.struct(k.cast("string").alias("row_id"), F.when(k % 5 != 0, F.floor(k / 3).cast("string")).alias("incident_id"), F.col("event_type").alias("incident_category"), F.when(k % 7 != 0, "37.75").alias("latitude"))
    return readers.incidents(spark, put(spark, lists(table(spark, sf, "events"), "event_id", row, "rows"), "incidents")).select("row_id", "incident_id", "incident_category", "latitude")


@REGISTRY.add("incident_pull_file", """
SELECT n_name AS source, n_nationkey::DOUBLE AS west, (n_nationkey + 200)::DOUBLE AS pad, '2024-01-01' AS window_start FROM nation""")
def incident_pull_file(spark, sf):
    k = F.col("n_nationkey").cast("double")
    doc = F.to_json(F.struct(F.col("n_name").alias("source"), F.array(F.lit(1.0), k, F.lit(3.0), F.lit(4.0)).alias("poi_bbox"), (k + 200).alias("pull_pad_m"), F.lit("2024-01-01").alias("window_start"), F.array(F.lit(1)).alias("rows")))
    found = readers.incident_pull(spark, put(spark, table(spark, sf, "nation").select(doc.alias("doc")), "pull"))
    return found.select("source", F.col("poi_bbox")[1].alias("west"), F.col("pull_pad_m").alias("pad"), "window_start")


def _csv(spark, rows: DataFrame, name: str) -> str:
    path = fresh_path(spark, name)
    writers.write_csv(rows, path)
    return path


@REGISTRY.add("placard_file", """
SELECT o_orderkey::VARCHAR AS inspection_id, 'A "b", c' || chr(10) || o_custkey AS name, CASE o_orderstatus WHEN 'F' THEN 'PASS' ELSE '' END AS facility_status, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders""")
def placard_file(spark, sf):
    """The second inspection era as CSV, with quotes, commas and line breaks."""
    empty = F.lit("")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("inspection_id"), F.concat(F.lit('A "b", c\n'), F.col("o_custkey").cast("string")).alias("name"), *(empty.alias(c) for c in ("address", "postal", "lat", "lon")),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.when(F.col("o_orderstatus") == "F", "PASS").otherwise("").alias("facility_status"),
        *(empty.alias(c) for c in ("inspection_type", "violation_observed", "description")))
    return readers.placard_inspections(spark, _csv(spark, rows, "placard")).select("inspection_id", "name", F.coalesce("facility_status", empty).alias("facility_status"), "date")


@REGISTRY.add("current_file", """
SELECT o_custkey::VARCHAR AS permit_number, o_orderkey::VARCHAR AS dba, strftime(o_orderdate, '%Y-%m-%d') AS inspection_date, (o_orderkey % 4) || '.0' AS violation_count FROM orders""")
def current_file(spark, sf):
    """The current inspection set as CSV."""
    empty = F.lit("")
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("permit_number"), F.col("o_orderkey").cast("string").alias("dba"), *(empty.alias(c) for c in ("street_address", "lat", "lon")),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("inspection_date"), *(empty.alias(c) for c in ("inspection_type", "facility_rating_status")),
        F.concat((F.col("o_orderkey") % 4).cast("string"), F.lit(".0")).alias("violation_count"), *(empty.alias(c) for c in ("violation_codes", "inspection_notes", "suspension_notes", "analysis_neighborhood", "data_as_of")))
    return readers.current_inspections(spark, _csv(spark, rows, "current")).select("permit_number", "dba", "inspection_date", "violation_count")


@REGISTRY.add("menu_file", """
SELECT n_name AS name, 'ok' AS status, 'section ' || r_name AS section, s_name AS item, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS price FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def menu_file(spark, sf):
    """A menu document for a thousand suppliers of a nation at a time, read back and exploded to items."""
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    item = F.struct(F.concat(F.lit("section "), F.col("r_name")).alias("section"), F.col("s_name").alias("item"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal")).alias("price"), F.lit("").alias("description"))
    docs = s.groupBy("n_name", F.floor(F.col("s_suppkey") / (20 * ROWS)).alias("g")).agg(F.collect_list(item).alias("items")).select(
        F.to_json(F.struct(F.col("n_name").alias("name"), F.lit("s").alias("source"), F.lit("2026-01-01").alias("as_of"), F.lit("ok").alias("status"), "items")).alias("doc"))
    return readers.menus(spark, put(spark, docs, "menus"), "*.txt").select("name", "status", F.inline("items")).drop("description")


@REGISTRY.add("product_file", """
SELECT p_brand AS store, p_name AS name, p_retailprice AS price, CASE WHEN p_size % 2 = 0 THEN p_size || ' Oz' ELSE '1 Each' END AS size FROM part""")
def product_file(spark, sf):
    p = table(spark, sf, "part")
    row = F.struct(F.col("p_type").alias("section"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 2 == 0, F.concat(F.col("p_size").cast("string"), F.lit(" Oz"))).otherwise("1 Each").alias("size"), F.col("p_retailprice").alias("price"))
    docs = p.groupBy("p_brand", F.floor(F.col("p_partkey") / (20 * ROWS)).alias("g")).agg(F.collect_list(row).alias("products")).select(F.to_json(F.struct(F.col("p_brand").alias("name"), F.lit("ok").alias("status"), "products")).alias("doc"))
    found = readers.product_lists(spark, put(spark, docs, "products"), "*.txt").select(F.col("name").alias("store"), F.explode("products").alias("p"))
    return found.select("store", "p.name", "p.price", "p.size")


@REGISTRY.add("record_file", """
SELECT p_partkey AS fdcId, 'Foundation' AS dataType, p_name AS description, 1008 AS nutrient, p_size::DOUBLE AS amount FROM part""")
def record_file(spark, sf):
    """Food records as the cache keeps them, an array of them a document."""
    nutrients = F.array(F.struct(F.lit(1008).alias("id"), F.lit("208").alias("number"), F.col("p_size").cast("double").alias("amount")))
    record = F.struct(F.col("p_partkey").alias("fdcId"), F.lit("Foundation").alias("dataType"), F.col("p_name").alias("description"), nutrients.alias("nutrients"))
    docs = lists(table(spark, sf, "part"), "p_partkey", record, None)
    return readers.food_records(spark, put(spark, docs, "records"), "*.txt").select("fdcId", "dataType", "description", F.inline("nutrients")).select("fdcId", "dataType", "description", F.col("id").alias("nutrient"), "amount")


@REGISTRY.add("label_file", "SELECT 'p' || p_partkey AS id, p_size / 2.0::DOUBLE AS serving_g, 'Sodium' AS name, p_retailprice AS amount FROM part")
def label_file(spark, sf):
    nutrients = F.array(F.struct(F.lit("Sodium").alias("name"), F.lit("mg").alias("unit"), F.col("p_retailprice").alias("amount")))
    label = F.struct(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), (F.col("p_size") / 2).alias("serving_g"), nutrients.alias("nutrients"))
    docs = lists(table(spark, sf, "part"), "p_partkey", label, None)
    return readers.labels(spark, put(spark, docs, "labels"), "*.txt").select("id", "serving_g", F.inline("nutrients")).drop("unit")


@REGISTRY.add("grocery_file", "SELECT p_name AS food, p_partkey AS fdcId FROM part")
def grocery_file(spark, sf):
    row = F.struct(F.col("p_name").alias("food"), F.col("p_partkey").alias("fdcId"))
    return readers.grocery_foods(spark, put(spark, lists(table(spark, sf, "part"), "p_partkey", row, "rows"), "grocery"))
