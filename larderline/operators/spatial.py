"""Radius counts, nearest points, polygon labels, bounding boxes."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larderline.functions import geo
from larderline.session import cut

FINE = 16        # fine tiles per cell side, about 42 m for the default box
SPLIT = 4        # a crowded tile has so many tiles a side at the next level
LEVELS = 3       # of tiles below the fine ones
CROWD = 64       # a tile on more distinct points than this is split
SLACK_M = 1e-6


def cell_of(box: tuple[float, float]) -> tuple[float, float]:
    """Sides of a coarse cell just larger than the half box, so that the neighbours of a cell hold all of a site's box."""
    return tuple(side * 61 / 60 for side in box)


def _tile(col: str, size: float, level: int = 0):
    return F.floor(F.col(col) / (size / (FINE * SPLIT ** level)))


def _around(df: DataFrame, cy: str, cx: str, reach: int = 1) -> DataFrame:
    steps = F.array(*[F.lit(i) for i in range(-reach, reach + 1)])
    return (df.withColumn("_dy", F.explode(steps)).withColumn("_dx", F.explode(steps))
            .withColumn(cy, F.col(cy) + F.col("_dy")).withColumn(cx, F.col(cx) + F.col("_dx"))
            .drop("_dy", "_dx"))


def with_tiles(points: DataFrame, cell: tuple[float, float]) -> DataFrame:
    """Points with their fine tile (y0, x0) and the tile that holds them at each level below (y1, x1, ...)."""
    return points.withColumns({f"{axis}{k}": _tile(c, side, k) for k in range(LEVELS + 1) for axis, c, side in (("y", "lat", cell[0]), ("x", "lon", cell[1]))})


def _tiles(points: DataFrame, level: int, measures: Sequence[str]) -> DataFrame:
    """Extent, rows and sums of the occupied tiles of a level; below the fine ones, only of tiles in a crowded one."""
    key = [f"y{level}", f"x{level}"]
    if level:
        above = [f"y{level - 1}", f"x{level - 1}"]
        crowded = points.groupBy(*above).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CROWD).select(*above)
        points = points.join(crowded, above, "left_semi")
        key = above + key
    return points.groupBy(*key).agg(
        F.min("lat").alias("lat0"), F.max("lat").alias("lat1"), F.min("lon").alias("lon0"), F.max("lon").alias("lon1"),
        F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(f"tile_{m}") for m in measures])


def _judged(pairs: DataFrame, radius_m: float, box: tuple[float, float]) -> DataFrame:
    """How near each tile is to its site, whether it is wholly inside the circle, and whether the circle may cut it."""
    lat, lon, zero = F.col("s_lat"), F.col("s_lon"), F.lit(0.0)
    gap_lat = F.greatest(zero, F.col("lat0") - lat, lat - F.col("lat1"))
    gap_lon = F.greatest(zero, F.col("lon0") - lon, lon - F.col("lon1"))
    span_lat = F.greatest(F.abs(F.col("lat0") - lat), F.abs(F.col("lat1") - lat))
    span_lon = F.greatest(F.abs(F.col("lon0") - lon), F.abs(F.col("lon1") - lon))
    cos0, cos1 = F.cos(F.radians("lat0")), F.cos(F.radians("lat1"))
    widest = F.when((F.col("lat0") <= 0) & (F.col("lat1") >= 0), 1.0).otherwise(F.greatest(cos0, cos1))
    return (
        pairs.filter((gap_lat <= box[0]) & (gap_lon <= box[1]))
        .withColumn("least_m", geo.metres_from_gap(gap_lat, gap_lon, lat, F.least(cos0, cos1)) - SLACK_M)
        .withColumn("most_m", geo.metres_from_gap(span_lat, span_lon, lat, widest) + SLACK_M)
        .withColumn("boxed", (span_lat <= box[0]) & (span_lon <= box[1]))
        .withColumn("inside", F.col("boxed") & (F.col("most_m") <= radius_m))
        .withColumn("edge", ~F.col("inside") & (F.col("least_m") <= radius_m))
        .drop("lat0", "lat1", "lon0", "lon1"))


def _levels(sites: DataFrame, points: DataFrame, radius_m: float, box: tuple[float, float], cell: tuple[float, float],
            measures: Sequence[str], nearest: bool) -> list[DataFrame]:
    """For each level, the tiles that count for a site: wholly ``inside``, or ``opened`` down to their points.

    A site meets at most 9 x 256 fine tiles however many points lie in them. Only tiles that the circle cuts, and with
    ``nearest`` the few that can hold the nearest point, go further: a crowded one to its tiles of the next level, of
    which again only those count, another to its points.
    """
    fine = _tiles(points, 0, measures)
    fine = _around(fine.withColumn("cy", F.floor(F.col("y0") / FINE)).withColumn("cx", F.floor(F.col("x0") / FINE)), "cy", "cx")
    s = sites.select(
        F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"),
        F.floor(_tile("lat", cell[0]) / FINE).alias("cy"), F.floor(_tile("lon", cell[1]) / FINE).alias("cx"))
    pairs, out = _judged(s.join(fine, ["cy", "cx"]).withColumn("reach", F.lit(None).cast("double")), radius_m, box), []
    sums = [f"tile_{m}" for m in measures]
    for level in range(LEVELS + 1):
        opened = F.col("edge")
        if nearest:
            # the window holds the tiles of one site that are still open
            reach = F.min(F.when(F.col("boxed"), F.col("most_m"))).over(Window.partitionBy("s_lat", "s_lon"))
            pairs = pairs.withColumn("reach", F.least("reach", reach))
            opened = opened | F.col("reach").isNull() | (F.col("least_m") <= F.col("reach"))
        pairs = pairs.withColumn("opened", opened).filter("inside or opened")
        key = [f"y{level}", f"x{level}"]
        down = F.col("opened") & (F.col("rows") > CROWD) if level < LEVELS else F.lit(False)
        out.append(pairs.filter(~down).select("s_lat", "s_lon", *key, "inside", "opened", *sums))
        if level < LEVELS:
            below = cut(pairs.filter(down).select("s_lat", "s_lon", *key, "reach"))
            if below.isEmpty():
                break
            pairs = _judged(below.join(_tiles(points, level + 1, measures), key), radius_m, box)
    return out


def _in_box(box):
    return ((F.abs(F.col("p_lat") - F.col("s_lat")) <= box[0])
            & (F.abs(F.col("p_lon") - F.col("s_lon")) <= box[1]))


def _every(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def radius_summary(sites: DataFrame, points: DataFrame, measures: Sequence[str], radius_m: float,
                   box: tuple[float, float]) -> DataFrame:
    """Per distinct site: sums of the measures within the radius and the nearest distance.

    ``points`` has one row per distinct (lat, lon) with additive measures; the
    nearest point is looked for inside the half box only, null outside it.
    """
    sites = sites.select("lat", "lon").distinct()
    cell = cell_of(box)
    points = cut(with_tiles(points, cell))  # read at each level
    found = []
    for level, pairs in enumerate(_levels(sites, points, radius_m, box, cell, measures, True)):
        key = [f"y{level}", f"x{level}"]
        detail = points.select(*[F.col(k).alias(f"p_{k}") for k in key], F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), *measures)
        opened = pairs.join(detail, [*[F.col(k) == F.col(f"p_{k}") for k in key], F.col("opened")], "left")
        d = F.when(_in_box(box), geo.metres(F.col("s_lat"), F.col("s_lon"), F.col("p_lat"), F.col("p_lon")))
        counted = [F.when(F.col("opened"), F.when(F.col("d") <= radius_m, F.col(m)).otherwise(0)).otherwise(F.col(f"tile_{m}")).alias(m) for m in measures]
        found.append(opened.withColumn("d", d).select("s_lat", "s_lon", "d", *counted))
    out = _every(found).groupBy("s_lat", "s_lon").agg(*[F.sum(m).alias(m) for m in measures], F.min("d").alias("nearest_m"))
    return out.withColumnsRenamed({"s_lat": "lat", "s_lon": "lon"})


def radius_by_category(sites: DataFrame, points: DataFrame, category: str, measure: str, radius_m: float,
                       box: tuple[float, float]) -> DataFrame:
    """Per distinct site and category: the measure summed within the radius.

    ``points`` has one row per distinct (lat, lon, category).
    """
    sites = sites.select("lat", "lon").distinct()
    cell = cell_of(box)
    points = cut(with_tiles(points, cell))  # read at each level
    found = []
    for level, pairs in enumerate(_levels(sites, points, radius_m, box, cell, [], False)):
        key = [f"y{level}", f"x{level}"]
        by_tile = points.groupBy(*key, category).agg(F.sum(measure).alias(measure))
        found.append(pairs.filter("inside").join(by_tile, key).select("s_lat", "s_lon", category, measure))
        detail = points.select(*key, F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), category, measure)
        near = geo.metres(F.col("s_lat"), F.col("s_lon"), F.col("p_lat"), F.col("p_lon")) <= radius_m
        found.append(pairs.filter("opened").join(detail, key).filter(_in_box(box)).filter(near).select("s_lat", "s_lon", category, measure))
    return (_every(found).groupBy("s_lat", "s_lon", category).agg(F.sum(measure).alias(measure))
            .withColumnsRenamed({"s_lat": "lat", "s_lon": "lon"}))


def label_points(points: DataFrame, polygons: DataFrame, out: str, cell: float = 0.02) -> DataFrame:
    """Name of the first polygon, by position, that holds each point; null for none.

    ``polygons`` is (pos, name, rings). Polygons are listed per grid cell they
    touch and the point's own cell is looked up, so points are not repeated and
    Spark may broadcast the list when it is small.
    """
    ring = F.col("rings")[0]
    lats, lons = F.transform(ring, lambda p: p["lat"]), F.transform(ring, lambda p: p["lon"])
    size = F.lit(cell)
    cells = (
        polygons
        .withColumn("_cy", F.explode(F.sequence(F.floor(F.array_min(lats) / size), F.floor(F.array_max(lats) / size))))
        .withColumn("_cx", F.explode(F.sequence(F.floor(F.array_min(lons) / size), F.floor(F.array_max(lons) / size))))
        .groupBy("_cy", "_cx")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "name", "rings"))).alias("_here")))
    at = (points.withColumn("_cy", F.floor(F.col("lat") / size))
          .withColumn("_cx", F.floor(F.col("lon") / size)))
    holds = F.filter("_here", lambda p: geo.in_polygon(F.col("lat"), F.col("lon"), p["rings"]))
    return (at.join(cells, ["_cy", "_cx"], "left")
            .withColumn(out, F.get(holds, F.lit(0))["name"]).drop("_cy", "_cx", "_here"))


def relabel_north_of(points: DataFrame, line: DataFrame, label: str, names: Sequence[str],
                     new_label: str) -> DataFrame:
    """Give points of the named areas another label when they lie north of a line.

    ``line`` is one row with the column ``line`` (west to east).
    """
    at = geo.line_latitude(F.col("lon"), F.col("_line"))
    north = F.col(label).isin(*names) & (F.col("lat") > at)
    return (points.withColumn("_line", line.select("line").scalar())
            .withColumn(label, F.when(north, new_label).otherwise(F.col(label))).drop("_line"))


def merge_line(segments: DataFrame, places: int = 7) -> DataFrame:
    """One west-to-east line of the distinct rounded points of all segments (lon, lat rows)."""
    pts = segments.select(F.struct(F.round("lon", places).alias("lon"),
                                   F.round("lat", places).alias("lat")).alias("p"))
    return pts.distinct().agg(F.array_sort(F.collect_list("p")).alias("line"))


def bounding_box(points: DataFrame, pad_m: float) -> DataFrame:
    """South, west, north, east rounded outward to 1e-4 degrees, and the padded pull box."""
    box = points.agg(
        (F.floor(F.min("lat") * 1e4) / 1e4).alias("south"), (F.floor(F.min("lon") * 1e4) / 1e4).alias("west"),
        (F.ceil(F.max("lat") * 1e4) / 1e4).alias("north"), (F.ceil(F.max("lon") * 1e4) / 1e4).alias("east"))
    dlat, dlon = pad_m / geo.METRES_PER_DEGREE, pad_m / (geo.METRES_PER_DEGREE * 0.79)
    return box.select("*", (F.col("south") - dlat).alias("pull_south"), (F.col("west") - dlon).alias("pull_west"),
                      (F.col("north") + dlat).alias("pull_north"), (F.col("east") + dlon).alias("pull_east"))


def box_covers(saved: DataFrame, current: DataFrame) -> DataFrame:
    """Whether a saved box (south, west, north, east) covers the current one."""
    c = current.select(F.struct("south", "west", "north", "east")).scalar()
    return saved.withColumn("_c", c).select(
        ((F.col("south") <= F.col("_c.south")) & (F.col("west") <= F.col("_c.west"))
         & (F.col("north") >= F.col("_c.north")) & (F.col("east") >= F.col("_c.east"))).alias("covers"))


def in_pull(rows: DataFrame, south: float, west: float, north: float, east: float, since: str,
            lat: str = "latitude", lon: str = "longitude", at: str = "incident_datetime") -> DataFrame:
    """Rows inside the pull box and not before ``since``."""
    return rows.filter(F.col(lat).try_cast("double").between(south, north)
                       & F.col(lon).try_cast("double").between(west, east)
                       & (F.col(at) >= F.lit(since)))
