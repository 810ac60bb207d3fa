"""Tables, snapshots, CSV and reading files written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from larderline.catalog.base import Registry, table
from larderline.operators.ordering import latest_rows
from larderline.session import fresh_path
from larderline.sources import readers, writers

REGISTRY = Registry()


def _path(spark, sf: str, name: str) -> str:
    return fresh_path(spark, f"{name}-{sf.strip('/').replace('/', '_')}")


@REGISTRY.add("table_write", "SELECT o_orderkey, o_custkey, o_totalprice, '1' AS schema_version FROM orders")
def table_write(spark, sf):
    path = _path(spark, sf, "orders")
    writers.write_table(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path, {"source": "orders"})
    version = spark.read.schema("schema_version string").json(f"{path}/meta").select("schema_version").scalar()
    return writers.read_table(spark, path).withColumn("schema_version", version)


@REGISTRY.add("snapshot_append", """
SELECT s_suppkey AS osm_id, day AS fetched_at, CASE WHEN s_suppkey % 2 = 0 OR day = '2026-01-02' THEN 'first' ELSE 'second' END AS source FROM supplier, (VALUES ('2026-01-01'), ('2026-01-02')) t(day)""")
def snapshot_append(spark, sf):
    """Two snapshots; the first is sent in two parts, of which the second repeats the first."""
    rows = table(spark, sf, "supplier").select(F.lit("node").alias("osm_type"), F.col("s_suppkey").alias("osm_id"), F.col("s_name").alias("name"))
    path = _path(spark, sf, "snapshots")
    writers.append_snapshot(rows.filter("osm_id % 2 = 0"), path, "2026-01-01", "first")
    writers.append_snapshot(rows, path, "2026-01-01", "second")
    writers.append_snapshot(rows, path, "2026-01-02", "first")
    return spark.read.parquet(path).select("osm_id", F.col("fetched_at").cast("string").alias("fetched_at"), "source")


@REGISTRY.add("csv_projection", """
SELECT c_custkey::VARCHAR AS business_id, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'He said "a, b"' || chr(10) || c_name END AS business_name, '2016-10-04' AS inspection_date FROM customer""")
def csv_projection(spark, sf):
    """A dataset with quotes, commas, line breaks and nulls, as CSV and back."""
    name = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit('He said "a, b"\n'), F.col("c_name")))
    raw = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), name.alias("title"), F.lit("2016-10-04T00:00:00").alias("day"), F.lit(1).alias(":@computed"))
    columns = {"business_id": "id", "business_name": "title", "business_address": "title", "postal": "title", "lat": "title", "lon": "title",
               "inspection_id": "id", "inspection_date": "day", "inspection_score": "id", "inspection_type": "title", "violation_id": "id",
               "violation_description": "title", "risk_category": "title"}
    path = _path(spark, sf, "csv")
    writers.write_csv(writers.csv_projection(writers.drop_computed(raw), columns, "day"), path)
    back = readers.scored_inspections(spark, path)
    return back.select("business_id", F.coalesce("business_name", F.lit("")).alias("business_name"), "inspection_date")


@REGISTRY.add("readings_file", """
SELECT user_id || '-' || event_type AS key, 'b' AS basis, arg_max(json_extract_string(props, '$.k'), struct_pack(t := ts, e := event_id)) AS c FROM events GROUP BY 1""")
def readings_file(spark, sf):
    """Map readings as JSON lines and back, the last one per key and basis."""
    events = table(spark, sf, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("key"), F.lit("b").alias("basis"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"),
        F.array(F.lit("m")).alias("models"), F.array(F.struct(F.get_json_object("props", "$.k").alias("c"), F.lit("p1").alias("p"))).alias("samples"), "event_id")
    path = _path(spark, sf, "readings")
    events.select("key", "basis", F.concat_ws("#", "at", F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("at"), "models", "samples").write.mode("overwrite").json(path)
    back = readers.map_readings(spark, path)
    return latest_rows(back, ["key", "basis"], ["at"]).select("key", "basis", F.get("samples", F.lit(0))["c"].alias("c"))


@REGISTRY.add("dataset_meta", "SELECT 'orders' AS dataset_id, count(*) AS rows FROM orders")
def dataset_meta(spark, sf):
    """A dataset profile written as a sidecar and read with its schema."""
    path = _path(spark, sf, "meta")
    table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("rows")).withColumn("dataset_id", F.lit("orders")).write.mode("overwrite").json(path)
    return readers.dataset_profiles(spark, path).select("dataset_id", "rows")


