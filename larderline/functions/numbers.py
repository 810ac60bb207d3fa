"""Rounding and printed precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(c: Column, places: int = 0) -> Column:
    """Half-to-even rounding of the exact binary value (2.675 -> 2.67, 0.5 -> 0).

    ``bround`` rounds the shortest decimal form instead. The product with the
    power of ten is taken with its rounding error (split multiplication), so a
    value just under a tie is told from the tie itself.
    """
    x = c.cast("double")
    scale = float(10 ** places)
    p = x * F.lit(scale)
    high = F.lit(134217729.0) * x
    high = high - (high - x)
    err = (high * scale - p) + (x - high) * scale
    low = F.floor(p).cast("double")
    part = p - low
    up = (part > 0.5) | ((part == 0.5) & ((err > 0) | ((err == 0) & (F.pmod(low, F.lit(2.0)) == 1.0))))
    return F.when(x.isNull(), None).otherwise((low + F.when(up, 1.0).otherwise(0.0)) / scale)


def printed_tolerance(c: Column) -> Column:
    """How far a value may sit from the one it was printed from.

    Half a unit of the last printed decimal or of the third significant
    figure, whichever is wider.
    """
    x = c.cast("double")
    text = F.format_string("%s", x)
    exponent = F.coalesce(F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int"), F.lit(0))
    digits = F.length(F.regexp_replace(F.regexp_extract(text, r"\.(\d+)", 1), "0+$", ""))
    places = F.greatest(digits - exponent, F.lit(0))
    figure = F.when(x == 0, 0.0).otherwise(
        F.lit(0.5) * F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))) - 2))
    return F.greatest(F.lit(0.5) * F.pow(F.lit(10.0), -places), figure) + F.lit(1e-9)


def not_number(c: Column) -> Column:
    return c.try_cast("double").isNull()
