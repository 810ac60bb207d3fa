"""One problem table over all built data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.operators import quality as Q


def report(checks: list[DataFrame]) -> DataFrame:
    """All findings; the data passes when none has severity fail."""
    return Q.union(checks)


def summary(findings: DataFrame) -> DataFrame:
    return findings.groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("n"))
