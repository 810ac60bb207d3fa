"""Registry of queries, table access, and the derivations shared by queries and SQL."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Registry:
    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None):
        def wrap(fn):
            self.queries[name] = fn
            if sql:
                self.sql[name] = sql
            return fn
        return wrap


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def point(key: str, span: int = 1000) -> tuple[Column, Column]:
    """Place point derived from a key, by integer arithmetic."""
    k = F.col(key)
    return (F.lit(37.70) + ((k * 7919) % span) / F.lit(10000.0), F.lit(-122.50) + ((k * 104729) % span) / F.lit(10000.0))


def point_sql(key: str, span: int = 1000) -> str:
    return (f"37.70::DOUBLE + (({key} * 7919) % {span}) / 10000.0::DOUBLE AS lat, "
            f"-122.50::DOUBLE + (({key} * 104729) % {span}) / 10000.0::DOUBLE AS lon")


def metres_sql(a: str, b: str, c: str, d: str) -> str:
    return (f"(6371000.0::DOUBLE * 2 * asin(sqrt(power(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c}))"
            f" * power(sin(radians({d} - {b}) / 2), 2))))")


FOLD_SQL = r"regexp_replace(strip_accents({0}), '[^\x00-\x7F]', '', 'g')"


def norm_sql(c: str) -> str:
    s = f"lower({FOLD_SQL.format(c)})"
    return (f"trim(regexp_replace(regexp_replace(regexp_replace({s}, '[-/&+]', ' ', 'g'), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g'))")
