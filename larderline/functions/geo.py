"""Distances, walk times, polygon tests."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from larderline.functions.numbers import round_even

EARTH_M = 6371000.0
METRES_PER_DEGREE = 111320.0


def _sin2(x: Column) -> Column:
    s = F.sin(x / 2)
    return s * s


def metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    a = (_sin2(F.radians(lat2 - lat1))
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * _sin2(F.radians(lon2 - lon1)))
    return F.lit(EARTH_M) * 2 * F.asin(F.sqrt(a))


def metres_from_gap(lat_gap: Column, lon_gap: Column, lat: Column, cos_other: Column) -> Column:
    """Distance for coordinate gaps in degrees; a bound when the gaps and the cosine are bounds."""
    a = _sin2(F.radians(lat_gap)) + F.cos(F.radians(lat)) * cos_other * _sin2(F.radians(lon_gap))
    return F.lit(EARTH_M) * 2 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def walk_minutes(lat: Column, lon: Column, home: tuple[float, float], pace: float) -> Column:
    m = metres(F.lit(home[0]), F.lit(home[1]), lat, lon)
    return F.greatest(F.lit(1), round_even(m / pace).cast("int"))


def in_ring(lat: Column, lon: Column, ring: Column) -> Column:
    """Even-odd test of a point against a ring of (lon, lat) structs."""
    n = F.size(ring)
    before = F.concat(F.slice(ring, n, F.lit(1)), F.slice(ring, F.lit(1), n - 1))

    def crosses(p: Column, q: Column) -> Column:
        rise = q["lat"] - p["lat"]
        at = (q["lon"] - p["lon"]) * (lat - p["lat"]) / F.when(rise == 0, 1e-12).otherwise(rise) + p["lon"]
        return ((p["lat"] > lat) != (q["lat"] > lat)) & (lon < at)

    hits = F.filter(F.zip_with(ring, before, crosses), lambda hit: hit)
    return F.size(hits) % 2 == 1


def in_polygon(lat: Column, lon: Column, rings: Column) -> Column:
    """Inside the outer ring and in none of the holes."""
    holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return in_ring(lat, lon, rings[0]) & ~F.exists(holes, lambda hole: in_ring(lat, lon, hole))


def line_latitude(lon: Column, line: Column) -> Column:
    """Latitude of a west-to-east line at a longitude; flat beyond its ends."""
    n = F.size(line)
    first, last = line[0], F.element_at(line, -1)
    segments = F.zip_with(F.slice(line, F.lit(1), n - 1), F.slice(line, F.lit(2), n - 1),
                          lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    seg = F.filter(segments, lambda s: (s["a"]["lon"] <= lon) & (lon <= s["b"]["lon"]))[0]
    run = seg["b"]["lon"] - seg["a"]["lon"]
    at = (seg["a"]["lat"] + (seg["b"]["lat"] - seg["a"]["lat"]) * (lon - seg["a"]["lon"])
          / F.when(run == 0, 1e-12).otherwise(run))
    return (F.when(lon <= first["lon"], first["lat"])
            .when(lon >= last["lon"], last["lat"])
            .otherwise(at))


def grid(side_m: float) -> tuple[float, int]:
    """Cell side in degrees, at most ``side_m`` on the ground, and the cells around the globe."""
    around = math.ceil(360.0 / (side_m / 111_400.0))
    return 360.0 / around, around


def grid_cell(lat: Column, lon: Column, side: tuple[float, int]) -> Column:
    return F.struct(F.floor(lat / side[0]).alias("y"),
                    F.pmod(F.floor(lon / side[0]), F.lit(side[1])).alias("x"))


def near_cells(lat: Column, lon: Column, limit_m: float, side: tuple[float, int]) -> Column:
    """Cells that can hold a point within ``limit_m`` of (lat, lon), the date line included."""
    step, around = side
    up = math.ceil(limit_m / 111_000.0 / step)
    cos = F.greatest(F.cos(F.radians(F.abs(lat) + 2 * step * up)), F.lit(0.005))
    wide = F.ceil(limit_m / 111_000.0 / cos / step).cast("int")
    here = grid_cell(lat, lon, side)
    return F.flatten(F.transform(F.sequence(F.lit(-up), F.lit(up)), lambda y: F.transform(
        F.sequence(-wide, wide),
        lambda x: F.struct((here["y"] + y).alias("y"), F.pmod(here["x"] + x, F.lit(around)).alias("x")))))
