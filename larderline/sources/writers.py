"""Writers of derived tables, snapshots, CSV projections and readings."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.operators.ordering import latest_rows

SCHEMA_VERSION = 1


def write_table(df: DataFrame, path: str, meta: Mapping[str, str] | None = None, partition_by: list[str] | None = None) -> None:
    """Parquet table with a one-row metadata table beside it."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/rows")
    info = {"schema_version": str(SCHEMA_VERSION), **(meta or {})}
    (df.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in info.items()])
     .coalesce(1).write.mode("overwrite").json(f"{path}/meta"))


def read_table(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows")


def _exists(spark, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def append_snapshot(rows: DataFrame, path: str, fetched_at: str, source: str) -> int:
    """Add a snapshot to an append-only table; rows whose key is already stored are ignored.

    The key is (osm_type, osm_id, fetched_at), so only the partition of this
    snapshot is compared. Returns its row count.
    """
    spark = rows.sparkSession
    new = (rows.dropDuplicates(["osm_type", "osm_id"]).withColumn("source", F.lit(source))
           .withColumn("fetched_at", F.lit(fetched_at)))
    if _exists(spark, path):
        stored = spark.read.option("recursiveFileLookup", False).parquet(path).filter(
            F.col("fetched_at").cast("string") == fetched_at)
        new = new.join(stored.select("osm_type", "osm_id"), ["osm_type", "osm_id"], "left_anti")
    new.write.mode("append").partitionBy("fetched_at").parquet(path)
    return snapshot_rows(spark, path, fetched_at).count()


def snapshot_rows(spark, path: str, fetched_at: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("fetched_at").cast("string") == fetched_at)


def drop_computed(df: DataFrame, prefix: str = ":@") -> DataFrame:
    """Without the columns a data portal computes."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith(prefix)])


def csv_projection(df: DataFrame, columns: Mapping[str, str], day: str) -> DataFrame:
    """Named columns as text: null is empty, the day column keeps its first ten characters."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return df.select(*[(F.substring(text(c), 1, 10) if c == day else text(c)).alias(name) for name, c in columns.items()])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"') \
        .option("emptyValue", "").csv(path)


def upsert_readings(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new readings, the new one per (key, basis) where both exist.

    Write the result to a new version folder: a table cannot be read and
    replaced in one job.
    """
    both = stored.drop("ord").withColumn("_new", F.lit(0)).unionByName(new.drop("ord").withColumn("_new", F.lit(1)))
    return latest_rows(both, ["key", "basis"], ["_new"]).drop("_new")
