"""Street risk: incidents within a radius of every place over the trailing window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.config import RiskRules
from larderline.functions.numbers import round_even
from larderline.operators import incidents as inc
from larderline.operators.ordering import first_rows, ordered_position, sum_before
from larderline.operators.spatial import radius_by_category, radius_summary
from larderline.session import cut


def counts(places: DataFrame, rows: DataFrame, rules: RiskRules = RiskRules()) -> DataFrame:
    """Bucket counts, totals and nearest distance per place (key, lat, lon, ...).

    ``total`` adds the bucket counts, so an incident in two buckets counts
    twice; ``total_distinct`` counts it once.
    """
    names = list(rules.buckets)
    touched = inc.collapse(rows, rules.buckets).withColumn("total_distinct", F.greatest(*names))
    measures = [*names, "total_distinct", "all_incidents"]
    found = radius_summary(places, inc.points(touched, [*names, "total_distinct"]), measures,
                           rules.radius_m, rules.box)
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return (
        places.join(found, ["lat", "lon"], "left")
        .withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in measures})
        .withColumn("total", total)
        .withColumn("per_month", round_even(F.col("total") / rules.months, 2))
        .withColumn("nearest_incident_m", round_even(F.col("nearest_m")).cast("int"))
        .drop("nearest_m"))


def ranked(counted: DataFrame) -> DataFrame:
    """Percentile of strictly lower totals and rank by (total desc, violent desc, key).

    The percentile needs the histogram of totals only. It stays small: D
    distinct totals take at least D*D/2 counted incidents.
    """
    counted = cut(counted)
    sizes = counted.groupBy("total").agg(F.count(F.lit(1)).alias("_n"))
    n = counted.agg(F.count(F.lit(1))).scalar()
    histogram = sum_before(cut(sizes), ["total"], "_n", "_below").select(
        "total", F.when(n > 1, round_even(100 * F.col("_below") / (n - 1), 1)).otherwise(0.0).alias("percentile"))
    order = counted.withColumn("_t", -F.col("total")).withColumn("_v", -F.col("violent"))
    return (ordered_position(order, [], ["_t", "_v", "key"], "rank").drop("_t", "_v")
            .join(histogram, "total"))


def street_risk(places: DataFrame, rows: DataFrame, rules: RiskRules = RiskRules()) -> DataFrame:
    return ranked(counts(places, rows, rules))


def top_categories(places: DataFrame, rows: DataFrame, rules: RiskRules = RiskRules()) -> DataFrame:
    """The most frequent categories near each place: (key, category, n), n desc then name."""
    near = radius_by_category(places, inc.category_points(rows), "category", "n", rules.radius_m, rules.box)
    near = first_rows(near, ["lat", "lon"], [F.desc("n"), F.asc("category")], rules.top_categories)
    return places.select("key", "lat", "lon").join(near, ["lat", "lon"]).select("key", "category", "n")


def layer(ranked_places: DataFrame, categories: DataFrame) -> DataFrame:
    """Risk layer with its categories nested, at most five a place."""
    nested = categories.groupBy("key").agg(F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "category", "n"))),
        lambda x: F.struct(x["category"].alias("category"), x["n"].alias("n"))).alias("top_categories"))
    return ranked_places.join(nested, "key", "left")


def geocoding_gaps(ranked_places: DataFrame, by: str, rules: RiskRules = RiskRules()) -> DataFrame:
    """Places whose zero only means that no incident point lies in the circle."""
    gap = (F.col("total") == 0) & (F.coalesce(F.col("nearest_incident_m"), F.lit(0)) > rules.radius_m)
    return ranked_places.filter(gap).groupBy(by).agg(F.count(F.lit(1)).alias("gaps"))


def highest(ranked_places: DataFrame, n: int = 10) -> DataFrame:
    return ranked_places.orderBy("rank").limit(n)


def lowest(ranked_places: DataFrame, category: str = "restaurant", n: int = 5) -> DataFrame:
    return ranked_places.filter(F.col("category") == category).orderBy("total", "violent", "key").limit(n)
