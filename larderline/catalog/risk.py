"""Street risk on suppliers as places and events as incidents."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from larderline.catalog.base import Registry, metres_sql, point, point_sql, table
from larderline.config import RiskRules
from larderline.operators.spatial import bounding_box, box_covers, in_pull
from larderline.plans import street_risk as plan

REGISTRY = Registry()
RULES = RiskRules(buckets={"violent": ("error",), "property": ("click", "view"), "drug": ("purchase",)})


def places(spark, sf):
    lat, lon = point("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), lat.alias("lat"), lon.alias("lon"),
        F.when(F.col("s_nationkey") % 2 == 0, "restaurant").otherwise("cafe").alias("category"),
        F.col("s_nationkey").alias("area"))


def incident_rows(spark, sf):
    iid = F.floor(F.col("event_id") / 3)
    return table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"), iid.alias("incident_id"), F.col("event_type").alias("incident_category"),
        (F.lit(37.70) + ((iid * 6151) % 997) / F.lit(10000.0)).alias("latitude"),
        (F.lit(-122.50) + ((iid * 3571) % 991) / F.lit(10000.0)).alias("longitude"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("incident_datetime"))


def base_sql(radius: float = 150, box: tuple[float, float] = (0.006, 0.0075)) -> str:
    return f"""
place AS (SELECT s_suppkey AS key, {point_sql('s_suppkey')},
          CASE WHEN s_nationkey % 2 = 0 THEN 'restaurant' ELSE 'cafe' END AS category, s_nationkey AS area FROM supplier),
inc AS (SELECT event_id // 3 AS iid, event_type FROM events),
incident AS (SELECT iid, 37.70::DOUBLE + ((iid * 6151) % 997) / 10000.0::DOUBLE AS ilat,
             -122.50::DOUBLE + ((iid * 3571) % 991) / 10000.0::DOUBLE AS ilon,
             max((event_type = 'error')::INT) AS v, max((event_type IN ('click', 'view'))::INT) AS p,
             max((event_type = 'purchase')::INT) AS dr FROM inc GROUP BY iid),
near AS (SELECT key, iid, v, p, dr, {metres_sql('lat', 'lon', 'ilat', 'ilon')} AS d FROM place, incident
         WHERE abs(ilat - lat) <= {box[0]}::DOUBLE AND abs(ilon - lon) <= {box[1]}::DOUBLE),
counted AS (SELECT place.key, any_value(category) AS category, any_value(area) AS area,
            coalesce(sum(v) FILTER (d <= {radius}), 0)::BIGINT AS violent,
            coalesce(sum(p) FILTER (d <= {radius}), 0)::BIGINT AS property,
            coalesce(sum(dr) FILTER (d <= {radius}), 0)::BIGINT AS drug,
            coalesce(sum(greatest(v, p, dr)) FILTER (d <= {radius}), 0)::BIGINT AS total_distinct,
            count(*) FILTER (d <= {radius}) AS all_incidents, round_even(min(d), 0)::INT AS nearest_incident_m
            FROM place LEFT JOIN near USING (key) GROUP BY place.key),
totals AS (SELECT *, violent + property + drug AS total FROM counted),
ranked AS (SELECT *, round_even(total / (365 / 30.4375::DOUBLE), 2)::DOUBLE AS per_month,
           row_number() OVER (ORDER BY total DESC, violent DESC, key) AS rank,
           round_even(100.0::DOUBLE * (rank() OVER (ORDER BY total) - 1) / (count(*) OVER () - 1), 1)::DOUBLE AS percentile
           FROM totals)
"""


BASE_SQL = base_sql()
_COLUMNS = "key, violent, property, drug, total, total_distinct, all_incidents, per_month, nearest_incident_m, percentile, rank"


@REGISTRY.add("street_risk", f"WITH {BASE_SQL} SELECT {_COLUMNS} FROM ranked")
def street_risk(spark, sf):
    out = plan.street_risk(places(spark, sf), incident_rows(spark, sf), RULES)
    return out.select(*_COLUMNS.split(", "))


@REGISTRY.add("risk_top_categories", f"""
WITH {BASE_SQL}, per AS (SELECT key, event_type AS category, count(DISTINCT iid) AS n
  FROM near JOIN inc USING (iid) WHERE d <= 150 GROUP BY key, event_type)
SELECT key, category, n FROM per QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, category) <= 5""")
def risk_top_categories(spark, sf):
    return plan.top_categories(places(spark, sf), incident_rows(spark, sf), RULES)


WIDE = replace(RULES, radius_m=2000, box=(0.03, 0.04))


@REGISTRY.add("street_risk_wide", f"WITH {base_sql(WIDE.radius_m, WIDE.box)} SELECT {_COLUMNS} FROM ranked")
def street_risk_wide(spark, sf):
    """A radius and a box of several times the default."""
    return plan.street_risk(places(spark, sf), incident_rows(spark, sf), WIDE).select(*_COLUMNS.split(", "))


@REGISTRY.add("risk_top_categories_wide", f"""
WITH {base_sql(WIDE.radius_m, WIDE.box)}, per AS (SELECT key, event_type AS category, count(DISTINCT iid) AS n
  FROM near JOIN inc USING (iid) WHERE d <= {WIDE.radius_m} GROUP BY key, event_type)
SELECT key, category, n FROM per QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, category) <= 5""")
def risk_top_categories_wide(spark, sf):
    return plan.top_categories(places(spark, sf), incident_rows(spark, sf), WIDE)


@REGISTRY.add("geocoding_gaps", f"""
WITH {BASE_SQL} SELECT area, count(*) AS gaps FROM ranked
WHERE total = 0 AND coalesce(nearest_incident_m, 0) > 150 GROUP BY area""")
def geocoding_gaps(spark, sf):
    return plan.geocoding_gaps(plan.counts(places(spark, sf), incident_rows(spark, sf), RULES), "area", RULES)


@REGISTRY.add("risk_extremes", f"""
WITH {BASE_SQL},
high AS (SELECT 'highest' AS side, key, rank, total FROM ranked ORDER BY rank LIMIT 10),
low AS (SELECT 'lowest' AS side, key, rank, total FROM ranked WHERE category = 'restaurant' ORDER BY total, violent, key LIMIT 5)
SELECT * FROM high UNION ALL SELECT * FROM low""")
def risk_extremes(spark, sf):
    ranked = plan.street_risk(places(spark, sf), incident_rows(spark, sf), RULES)
    side = lambda df, name: df.select(F.lit(name).alias("side"), "key", "rank", "total")
    return side(plan.highest(ranked), "highest").unionByName(side(plan.lowest(ranked), "lowest"))


@REGISTRY.add("bbox_profile", f"""
WITH place AS (SELECT s_suppkey AS key, {point_sql('s_suppkey')} FROM supplier),
box AS (SELECT floor(min(lat) * 1e4) / 1e4 AS south, floor(min(lon) * 1e4) / 1e4 AS west,
        ceil(max(lat) * 1e4) / 1e4 AS north, ceil(max(lon) * 1e4) / 1e4 AS east FROM place)
SELECT south::DOUBLE AS south, west::DOUBLE AS west, north::DOUBLE AS north, east::DOUBLE AS east,
  south - 200.0::DOUBLE / 111320 AS pull_south, west - 200.0::DOUBLE / (111320 * 0.79::DOUBLE) AS pull_west,
  north + 200.0::DOUBLE / 111320 AS pull_north, east + 200.0::DOUBLE / (111320 * 0.79::DOUBLE) AS pull_east,
  (south <= 37.75::DOUBLE AND west <= -122.45::DOUBLE AND north >= 37.76::DOUBLE AND east >= -122.44::DOUBLE) AS covers
FROM box""")
def bbox_profile(spark, sf):
    box = bounding_box(places(spark, sf), RULES.pull_pad_m)
    probe = table(spark, sf, "region").filter("r_regionkey = 0").select(
        F.lit(37.75).alias("south"), F.lit(-122.45).alias("west"), F.lit(37.76).alias("north"), F.lit(-122.44).alias("east"))
    return box.withColumn("covers", box_covers(box, probe).scalar())


@REGISTRY.add("incident_pull", """
WITH i AS (SELECT event_id, event_id // 3 AS iid, ts FROM events),
g AS (SELECT *, 37.70::DOUBLE + ((iid * 6151) % 997) / 10000.0::DOUBLE AS lat,
      -122.50::DOUBLE + ((iid * 3571) % 991) / 10000.0::DOUBLE AS lon FROM i)
SELECT event_id AS row_id, iid AS incident_id FROM g
WHERE lat BETWEEN 37.72::DOUBLE AND 37.76::DOUBLE AND lon BETWEEN -122.48::DOUBLE AND -122.43::DOUBLE
  AND strftime(ts, '%Y-%m-%dT%H:%M:%S') >= '2024-01-10T00:00:00'""")
def incident_pull(spark, sf):
    return in_pull(incident_rows(spark, sf), 37.72, -122.48, 37.76, -122.43, "2024-01-10T00:00:00").select("row_id", "incident_id")


@REGISTRY.add("risk_layer", f"""
WITH {BASE_SQL}, per AS (SELECT key, event_type AS category, count(DISTINCT iid) AS n FROM near JOIN inc USING (iid) WHERE d <= 150 GROUP BY key, event_type),
top AS (SELECT * FROM per QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, category) <= 5),
txt AS (SELECT key, string_agg(category || '=' || n, ',' ORDER BY n DESC, category) AS top_categories FROM top GROUP BY key)
SELECT key, total, percentile, top_categories FROM ranked LEFT JOIN txt USING (key)""")
def risk_layer(spark, sf):
    p, rows = places(spark, sf), incident_rows(spark, sf)
    out = plan.layer(plan.street_risk(p, rows, RULES), plan.top_categories(p, rows, RULES))
    text = F.array_join(F.transform("top_categories", lambda c: F.concat(c["category"], F.lit("="), c["n"].cast("string"))), ",")
    return out.select("key", "total", "percentile", text.alias("top_categories"))
