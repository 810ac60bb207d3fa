"""Greedy duplicate removal by name and distance, and the keys of the kept rows."""

from __future__ import annotations

import math
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larderline.functions import geo
from larderline.operators.ordering import ROWS_PER_TASK, each, first_rows, ordered_position
from larderline.session import cut

ROUNDS = 2  # in which the earliest rows around are kept before the rest is folded


def _first_around(rows: DataFrame, limit_m: float) -> tuple[DataFrame, DataFrame]:
    """(kept, open): the rows that are the earliest of all around them, and those that are near none of these.

    A cell is small enough to hold at most one kept row. The first row of a cell is kept when no cell around has an
    earlier one. Only one row a cell takes part in the comparison, so no pairs within a name are formed.
    """
    near = geo.near_cells(F.col("lat"), F.col("lon"), limit_m, _grid(limit_m))
    heads = first_rows(rows, ["_norm", "_y", "_x"], [F.asc("_ord")])
    earliest = each(heads, near, "_c").groupBy("_norm", F.col("_c.y").alias("_y"), F.col("_c.x").alias("_x")).agg(F.min("_ord").alias("_first"))
    winners = cut(heads.join(earliest, ["_norm", "_y", "_x"]).filter("_ord = _first").drop("_first"))
    reach = each(winners, near, "_c").select(
        F.col("_norm").alias("w_norm"), F.col("_c.y").alias("w_y"), F.col("_c.x").alias("w_x"), F.col("lat").alias("w_lat"), F.col("lon").alias("w_lon"))
    close = geo.metres(F.col("lat"), F.col("lon"), F.col("w_lat"), F.col("w_lon")) <= limit_m
    return winners, cut(rows.join(reach, [F.col("_norm") == F.col("w_norm"), F.col("_y") == F.col("w_y"), F.col("_x") == F.col("w_x"), close], "left_anti"))


def _grid(limit_m: float) -> tuple[float, int]:
    return geo.grid(limit_m / math.sqrt(2.0))


def _split(rows: DataFrame, keys: list[str], axis: str, reach: Column, out: str, around: int = 0) -> DataFrame:
    """A number for each run of values of ``axis`` without a gap above ``reach``; with ``around``, the axis is a circle.

    The windows are over the different cells of one name along one axis, of which the globe has a fixed number.
    """
    w = Window.partitionBy(*keys)
    lines = rows.groupBy(*keys, axis).agg(F.max(reach).alias("_reach")).withColumn("_reach", F.max("_reach").over(w))
    gap = F.col(axis) - F.lag(axis).over(w.orderBy(axis)) > F.col("_reach")
    lines = lines.withColumn("_gap", gap.cast("int")).withColumn(out, F.coalesce(F.sum("_gap").over(w.orderBy(axis)), F.lit(0)))
    if around:
        meets = F.min(axis).over(w) + around - F.max(axis).over(w) <= F.col("_reach")
        lines = lines.withColumn(out, F.when(meets & (F.col(out) == F.max(out).over(w)), 0).otherwise(F.col(out)))
    return rows.join(lines.select(*keys, axis, out), [*keys, axis])


def _folded(rows: DataFrame, limit_m: float) -> DataFrame:
    """The rows that a greedy pass in ``_ord`` order keeps, each region of a name apart.

    Regions are split where a name has no row for more than the limit, to the north or the east. The rows of a region
    pass one by one, and only the kept ones are held: one a cell at most.
    """
    step, around = side = _grid(limit_m)
    up = math.ceil(limit_m / 111_000.0 / step)
    wide = lambda lat: math.ceil(limit_m / 111_000.0 / max(math.cos(math.radians(abs(lat) + 2 * step * up)), 0.005) / step)
    cos = F.greatest(F.cos(F.radians(F.abs("lat") + 2 * step * up)), F.lit(0.005))
    slabs = _split(rows, ["_norm"], "_y", F.lit(up), "_slab")
    regions = _split(slabs, ["_norm", "_slab"], "_x", F.ceil(limit_m / 111_000.0 / cos / step), "_region", around)
    keys = ["_norm", "_slab", "_region"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept = None, {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*keys, "_y", "_x", "lat", "lon")]
            out = []
            for k, (name, slab, region, y, x, lat, lon) in enumerate(zip(*columns)):
                if (name, slab, region) != now:
                    now, kept = (name, slab, region), {}
                n = wide(lat)
                across = range(x - n, x + n + 1) if 2 * n < around else range(around)
                if not any((q := kept.get((v, u % around))) and _metres(lat, lon, *q) <= limit_m for v in range(y - up, y + up + 1) for u in across):
                    kept[y, x] = lat, lon
                    out.append(k)
            yield batch.select(["_norm", "_ord"]).take(pa.array(out, pa.int64()))

    slim = regions.select(*keys, "_ord", "_y", "_x", "lat", "lon")
    return slim.repartition(*keys).sortWithinPartitions(*keys, "_ord").mapInArrow(run, slim.select("_norm", "_ord").schema)


def _metres(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return geo.EARTH_M * 2 * math.asin(math.sqrt(a))


def keep_distinct_places(places: DataFrame, name_key: Column, ordinal: str, limit_m: float, rounds: int = ROUNDS) -> DataFrame:
    """Drop a place within ``limit_m`` of an earlier kept place with the same normalized name.

    ``ordinal`` is a unique column that states the order. The result has
    ``first_of_name``: true on the first kept place of a name, which carries
    the bare name as key.

    A name on one row is kept. For the others, a fixed number of ``rounds`` keeps the rows that are the earliest around,
    which settles crowded places, and one ordered pass a region the rest. The number of jobs doesn't depend on the data.
    """
    named = places.withColumn("_norm", name_key).withColumn("_ord", F.col(ordinal))
    here = geo.grid_cell(F.col("lat"), F.col("lon"), _grid(limit_m))
    # rows at the very same point: only the first can be kept
    points = cut(named.groupBy("_norm", "lat", "lon").agg(F.min("_ord").alias("_ord")).withColumns({"_y": here["y"], "_x": here["x"]}))
    single = points.groupBy("_norm").agg(F.count(F.lit(1)).alias("_n"), F.min("_ord").alias("_ord")).filter("_n = 1")
    kept, open_rows = single.select("_norm", "_ord"), points.join(single.select("_norm"), "_norm", "left_anti")
    for _ in range(rounds):
        winners, open_rows = _first_around(open_rows, limit_m)
        kept = kept.unionByName(winners.select("_norm", "_ord"))
    kept = cut(kept.unionByName(_folded(open_rows, limit_m)))
    first = kept.groupBy("_norm").agg(F.min("_ord").alias("_first"))
    kept = kept.join(first, "_norm").select(F.col("_ord"), (F.col("_ord") == F.col("_first")).alias("first_of_name"))
    return named.join(kept, "_ord").drop("_norm", "_ord")


def place_key(name: Column, addr: Column, lat: Column, lon: Column, first: Column) -> Column:
    """The bare name for the first of a name, else the name with its address or its point."""
    at = F.format_string("%s (%.5f,%.5f)", name, lat, lon)
    return (F.when(first, name)
            .when(F.coalesce(addr, F.lit("")) != "", F.format_string("%s (%s)", name, addr))
            .otherwise(at))


def suffix_ids(rows: DataFrame, base: str, order: list[str], out: str,
               rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``base`` for the first row of a base, ``base-2``, ``base-3``... for the next ones."""
    n = ordered_position(rows, [base], order, "_pos", rows_per_task)
    return n.withColumn(out, F.when(F.col("_pos") == 1, F.col(base))
                        .otherwise(F.concat_ws("-", base, F.col("_pos").cast("string")))).drop("_pos")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def numbered_chunks(ids: DataFrame, column: str, size: int) -> DataFrame:
    """Request number of each id: ids in ascending order, ``size`` a request."""
    return (ordered_position(cut(ids.select(column).distinct()), [], [column], "_pos")
            .withColumn("request", F.floor((F.col("_pos") - 1) / size)).drop("_pos"))
