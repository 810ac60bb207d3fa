"""Place index queries on parts, customers and suppliers with derived points."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from larderline.catalog.base import Registry, metres_sql, norm_sql, point, point_sql, table
from larderline.config import PlaceRules
from larderline.functions import text as X
from larderline.operators import places as P
from larderline.operators import reports as R
from larderline.operators.dedup import keep_distinct_places, place_key
from larderline.operators.spatial import label_points, merge_line, relabel_north_of
from larderline.plans import place_index as plan
from larderline.session import fresh_path
from larderline.sources import readers

REGISTRY = Registry()
SPLIT = ("NATION_3", "NATION_8", "NATION_15")
HOME = PlaceRules().home

# ring corners as (lon, lat) offsets in thousandths of a degree around a nation's centre
OUTER = ((-20, -12), (15, -18), (22, 9), (3, 4), (-11, 19))
HOLE = ((-4, -4), (4, -4), (4, 2), (-4, 2))


def polygons(spark, sf):
    k = F.col("n_nationkey")
    lat, lon = F.lit(37.70) + ((k * 37) % 100) / F.lit(1000.0), F.lit(-122.50) + ((k * 53) % 100) / F.lit(1000.0)
    ring = lambda corners: F.array(*[F.struct((lon + F.lit(x / 1000.0)).alias("lon"),
                                              (lat + F.lit(y / 1000.0)).alias("lat")) for x, y in corners])
    return table(spark, sf, "nation").select(k.alias("pos"), F.col("n_name").alias("name"),
                                             F.array(ring(OUTER), ring(HOLE)).alias("rings"))


def split_line(spark, sf):
    k = F.col("r_regionkey")
    twice = table(spark, sf, "region").unionByName(table(spark, sf, "region"))
    return merge_line(twice.select((F.lit(-122.50) + k * F.lit(0.025)).alias("lon"),
                                   (F.lit(37.74) + ((k * k) % 3) * F.lit(0.006)).alias("lat")))


def _edges(name: str, corners) -> str:
    rows = []
    for i, (x, y) in enumerate(corners):
        px, py = corners[i - 1]
        rows.append(f"('{name}', {x / 1000.0}::DOUBLE, {y / 1000.0}::DOUBLE, {px / 1000.0}::DOUBLE, {py / 1000.0}::DOUBLE)")
    return ", ".join(rows)


LABEL_SQL = f"""
edge_offset(ring, x, y, px, py) AS (VALUES {_edges('outer', OUTER)}, {_edges('hole', HOLE)}),
centre AS (SELECT n_nationkey AS pos, n_name AS name, 37.70::DOUBLE + ((n_nationkey * 37) % 100) / 1000.0::DOUBLE AS clat,
           -122.50::DOUBLE + ((n_nationkey * 53) % 100) / 1000.0::DOUBLE AS clon FROM nation),
edge AS (SELECT pos, name, ring, clon + x AS xi, clat + y AS yi, clon + px AS xj, clat + py AS yj FROM centre, edge_offset),
spot AS (SELECT DISTINCT lat, lon FROM pts),
crossed AS (SELECT lat, lon, pos, any_value(name) AS name,
            count(*) FILTER (ring = 'outer' AND hit) % 2 = 1 AND count(*) FILTER (ring = 'hole' AND hit) % 2 = 0 AS inside
            FROM (SELECT lat, lon, pos, name, ring, (yi > lat) <> (yj > lat) AND
                  lon < (xj - xi) * (lat - yi) / (CASE WHEN yj = yi THEN 1e-12 ELSE yj - yi END) + xi AS hit FROM spot, edge)
            GROUP BY lat, lon, pos),
area AS (SELECT lat, lon, arg_min(name, pos) AS area FROM crossed WHERE inside GROUP BY lat, lon),
line_pt AS (SELECT row_number() OVER (ORDER BY r_regionkey) AS i, round(-122.50::DOUBLE + r_regionkey * 0.025::DOUBLE, 7) AS x,
            round(37.74::DOUBLE + ((r_regionkey * r_regionkey) % 3) * 0.006::DOUBLE, 7) AS y FROM region),
seg AS (SELECT a.i, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1 FROM line_pt a JOIN line_pt b ON b.i = a.i + 1),
on_line AS (SELECT lat, lon, y0 + (y1 - y0) * (lon - x0) / (CASE WHEN x1 = x0 THEN 1e-12 ELSE x1 - x0 END) AS slope_lat
            FROM spot JOIN seg ON lon BETWEEN x0 AND x1 QUALIFY row_number() OVER (PARTITION BY lat, lon ORDER BY i) = 1),
line_at AS (SELECT lat, lon, CASE WHEN lon <= (SELECT arg_min(x, i) FROM line_pt) THEN (SELECT arg_min(y, i) FROM line_pt)
            WHEN lon >= (SELECT arg_max(x, i) FROM line_pt) THEN (SELECT arg_max(y, i) FROM line_pt) ELSE slope_lat END AS line_lat
            FROM spot LEFT JOIN on_line USING (lat, lon)),
labelled AS (SELECT pts.*, CASE WHEN area IN ('{"', '".join(SPLIT)}') AND pts.lat > line_at.line_lat THEN 'north side' ELSE area END AS neighborhood
             FROM pts LEFT JOIN area USING (lat, lon) LEFT JOIN line_at USING (lat, lon))
"""


@REGISTRY.add("point_in_polygon", f"""
WITH pts AS (SELECT c_custkey, {point_sql('c_custkey')} FROM customer), {LABEL_SQL}
SELECT c_custkey, neighborhood FROM labelled""")
def point_in_polygon(spark, sf):
    lat, lon = point("c_custkey")
    pts = table(spark, sf, "customer").select("c_custkey", lat.alias("lat"), lon.alias("lon"))
    out = label_points(pts, polygons(spark, sf), "neighborhood")
    out = relabel_north_of(out, split_line(spark, sf), "neighborhood", SPLIT, "north side")
    return out.select("c_custkey", "neighborhood")


@REGISTRY.add("polygons_from_geojson", f"""
WITH pts AS (SELECT s_suppkey, {point_sql('s_suppkey')} FROM supplier), {LABEL_SQL}
SELECT s_suppkey, neighborhood FROM labelled""")
def polygons_from_geojson(spark, sf):
    """The same polygons written as a feature collection and read back."""
    pair = lambda p: F.array(p["lon"], p["lat"])
    ring = lambda r: F.transform(r, pair)
    shape = F.transform("rings", ring)
    empty = F.lit(None).cast("string")
    feats = polygons(spark, sf).select("pos", F.to_json(F.struct(
        F.struct("name", empty.alias("kind"), F.col("name").alias("nhood")).alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"), F.array(shape).alias("coordinates")).alias("geometry"))).alias("f"))
    line = split_line(spark, sf).select(F.lit(1000000).alias("pos"), F.to_json(F.struct(
        F.struct(F.lit("line").alias("name"), F.lit("split_line").alias("kind")).alias("properties"),
        F.struct(F.lit("LineString").alias("type"), F.transform("line", pair).alias("coordinates")).alias("geometry"))).alias("f"))
    # the areas of a map are few: one feature per nation
    doc = feats.unionByName(line).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "f"))), lambda x: x["f"]), ",").alias("fs")).select(
        F.concat(F.lit('{"type": "FeatureCollection", "features": ['), "fs", F.lit("]}")).alias("value"))
    path = fresh_path(spark, "geojson")
    doc.write.mode("overwrite").text(path)
    feats = readers.features(spark, path)
    lat, lon = point("s_suppkey")
    pts = table(spark, sf, "supplier").select("s_suppkey", lat.alias("lat"), lon.alias("lon"))
    areas = readers.keep_areas(feats, [f"NATION_{i}" for i in range(25)])
    out = label_points(pts, readers.polygons(areas), "neighborhood")
    return relabel_north_of(out, readers.split_line(feats), "neighborhood", SPLIT, "north side").select("s_suppkey", "neighborhood")


@REGISTRY.add("walk_minutes", f"""
WITH pts AS (SELECT s_suppkey, {point_sql('s_suppkey')} FROM supplier)
SELECT s_suppkey, greatest(1, round_even({metres_sql(f'{HOME[0]}::DOUBLE', f'({HOME[1]}::DOUBLE)', 'lat', 'lon')} / 80, 0)::INT) AS walk_minutes FROM pts""")
def walk_minutes(spark, sf):
    lat, lon = point("s_suppkey")
    pts = table(spark, sf, "supplier").select("s_suppkey", lat.alias("lat"), lon.alias("lon"))
    return P.with_walk(pts).select("s_suppkey", F.col("walkMin").alias("walk_minutes"))


@REGISTRY.add("place_filter", """
SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'red') AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')
  AND p_type IN ('PROMO', 'SMALL') ORDER BY p_size, p_name""")
def place_filter(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("category"),
                                           F.col("p_type").alias("neighborhood"), F.col("p_size").alias("walkMin"))
    found = P.search(rows, "Red", categories=("Brand#1", "Brand#2", "Brand#3"), areas=("PROMO", "SMALL"))
    return P.in_walk_order(found).select("p_partkey", F.col("name").alias("p_name"))


def _named_parts(spark, sf):
    lat, lon = point("p_partkey", 100)
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.replace("p_name", F.lit(" "), F.lit(" - ")))
    addr = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.concat_ws(" ", F.col("p_size").cast("string"), "p_brand"))
    return table(spark, sf, "part").select("p_partkey", name.alias("name"), addr.alias("addr"), lat.alias("lat"), lon.alias("lon"))


_PARTS_SQL = f"""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE replace(p_name, ' ', ' - ') END AS name,
  CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_size || ' ' || p_brand END AS addr, {point_sql('p_partkey', 100)} FROM part"""


def greedy_sql(source: str, order: str) -> str:
    """Greedy pass over each normalized name of ``source`` (name, lat, lon and ``order``)."""
    return f"""
numbered AS (SELECT *, {norm_sql('name')} AS norm, row_number() OVER (PARTITION BY {norm_sql('name')} ORDER BY {order}) AS rn FROM {source}),
fold(norm, rn, kept) AS (
  SELECT norm, rn, [{{'rn': rn, 'lat': lat, 'lon': lon}}] FROM numbered WHERE rn = 1
  UNION ALL
  SELECT f.norm, n.rn, CASE WHEN len(list_filter(f.kept, lambda k: {metres_sql('n.lat', 'n.lon', 'k.lat', 'k.lon')} <= 150)) > 0
    THEN f.kept ELSE list_append(f.kept, {{'rn': n.rn, 'lat': n.lat, 'lon': n.lon}}) END
  FROM fold f JOIN numbered n ON n.norm = f.norm AND n.rn = f.rn + 1),
last_fold AS (SELECT norm, kept FROM fold QUALIFY row_number() OVER (PARTITION BY norm ORDER BY rn DESC) = 1),
kept_rows AS (SELECT norm, k.rn AS rn, k.rn = 1 AS first_of_name FROM (SELECT norm, unnest(kept) AS k FROM last_fold)),
kept AS (SELECT numbered.*, first_of_name FROM numbered JOIN kept_rows USING (norm, rn))"""


KEY_SQL = ("CASE WHEN first_of_name THEN name WHEN coalesce(addr, '') <> '' THEN name || ' (' || addr || ')' "
           "ELSE name || ' (' || printf('%.5f', lat) || ',' || printf('%.5f', lon) || ')' END")


@REGISTRY.add("place_keys", f"""
WITH RECURSIVE src AS ({_PARTS_SQL}), {greedy_sql('src', 'p_partkey')}
SELECT p_partkey, {KEY_SQL} AS key, first_of_name FROM kept""")
def place_keys(spark, sf):
    kept = keep_distinct_places(_named_parts(spark, sf), X.normal_name(F.col("name")), "p_partkey", 150.0)
    return kept.select("p_partkey", place_key(F.col("name"), F.col("addr"), F.col("lat"), F.col("lon"),
                                              F.col("first_of_name")).alias("key"), "first_of_name")


def _overrides(spark, sf):
    k = F.col("n_nationkey")
    return table(spark, sf, "nation").filter(k % 2 == 0).select(
        F.lower("n_name").alias("place"), k.alias("pos"), F.col("n_regionkey").alias("price"),
        F.when(k % 4 == 0, F.when(k % 3 == 0, "pick").otherwise("ok")).alias("verdict"),
        F.when(k % 3 == 0, F.concat(F.lit("note "), k.cast("string"))).alias("notes"))


@REGISTRY.add("overlay_merge", f"""
WITH o AS (SELECT {norm_sql('lower(n_name)')} AS norm, n_regionkey AS price,
  CASE WHEN n_nationkey % 4 = 0 THEN CASE WHEN n_nationkey % 3 = 0 THEN 'pick' ELSE 'ok' END END AS verdict,
  CASE WHEN n_nationkey % 3 = 0 THEN 'note ' || n_nationkey END AS notes FROM nation WHERE n_nationkey % 2 = 0),
b AS (SELECT c_custkey, 'Nation ' || c_nationkey AS name, 9 AS price, c_mktsegment AS verdict FROM customer)
SELECT c_custkey, coalesce(o.price, b.price) AS price, coalesce(o.verdict, b.verdict) AS verdict, notes
FROM b LEFT JOIN o ON replace({norm_sql('b.name')}, ' ', '') = o.norm""")
def overlay_merge(spark, sf):
    base = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("name"),
        F.lit(9).alias("price"), F.col("c_mktsegment").alias("verdict"))
    return P.overlay(base, _overrides(spark, sf)).select("c_custkey", "price", "verdict", "notes")


def elements(spark, sf):
    """Parts as raw elements with an open tag map."""
    k = F.col("p_partkey")
    lat, lon = point("p_partkey", 997)
    amenity = F.when(k % 5 == 0, "restaurant").when(k % 5 == 1, "fast_food").when(k % 5 == 2, "cafe")
    shop = F.when(k % 5 == 3, F.when(k % 2 == 0, "bakery").otherwise("tea")).when(k % 5 == 4, "florist")
    tags = {
        "name": F.when(k % 7 != 0, F.col("p_name")), "amenity": amenity, "shop": shop,
        "cuisine": F.replace("p_name", F.lit(" "), F.lit("_")),
        "addr:housenumber": F.when(k % 3 == 0, F.col("p_size").cast("string")),
        "addr:street": F.when(k % 4 != 0, F.col("p_brand")), "addr:full": F.col("p_type"),
        "addr:postcode": F.when(k % 6 == 0, "94133"), "website": F.when(k % 8 == 0, F.lit("")),
        "contact:website": F.when(k % 2 == 0, F.concat(F.lit("w"), k.cast("string"))),
        "phone": F.when(k % 9 == 0, k.cast("string")), "opening_hours": F.when(k % 10 == 0, F.lit("24/7")),
    }
    entries = F.array(*[F.struct(F.lit(n).alias("k"), v.alias("v")) for n, v in tags.items()])
    tag_map = F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))
    own = F.when(k % 11 != 0, lat), F.when(k % 11 != 0, lon)
    center = F.when((k % 11 == 0) & (k % 2 == 0), F.struct(lat.alias("lat"), lon.alias("lon")))
    return table(spark, sf, "part").select(
        k.alias("pos"), F.when(k % 2 == 0, "node").otherwise("way").alias("type"), k.alias("id"), own[0].alias("lat"),
        own[1].alias("lon"), center.alias("center"), tag_map.alias("tags"))


ELEMENT_SQL = f"""
raw AS (SELECT p_partkey AS pos, CASE WHEN p_partkey % 2 = 0 THEN 'node' ELSE 'way' END AS osm_type, p_partkey AS osm_id,
  CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS name,
  CASE WHEN p_partkey % 5 IN (0, 1) THEN 'restaurant' WHEN p_partkey % 5 = 2 THEN 'cafe' ELSE 'grocery' END AS category,
  CASE p_partkey % 5 WHEN 0 THEN 'restaurant' WHEN 1 THEN 'fast_food' WHEN 2 THEN 'cafe'
    WHEN 3 THEN CASE WHEN p_partkey % 2 = 0 THEN 'bakery' ELSE 'tea' END ELSE 'florist' END AS subtype,
  p_name AS cuisine,
  CASE WHEN p_partkey % 3 = 0 AND p_partkey % 4 <> 0 THEN p_size || ' ' || p_brand WHEN p_partkey % 4 <> 0 THEN p_brand END AS local_addr,
  p_type AS full_addr, CASE WHEN p_partkey % 6 = 0 THEN '94133' END AS postal,
  {point_sql('p_partkey', 997)},
  CASE WHEN p_partkey % 2 = 0 THEN 'w' || p_partkey END AS website, CASE WHEN p_partkey % 9 = 0 THEN p_partkey::VARCHAR END AS phone,
  CASE WHEN p_partkey % 10 = 0 THEN '24/7' END AS opening_hours
  FROM part WHERE p_partkey % 11 <> 0 OR p_partkey % 2 = 0),
base AS (SELECT osm_type, osm_id, name, category, subtype, cuisine, coalesce(local_addr, full_addr) AS addr, postal,
  round_even(lat, 6)::DOUBLE AS lat, round_even(lon, 6)::DOUBLE AS lon, website, phone, opening_hours FROM raw
  WHERE subtype NOT IN ('tea', 'florist'))
"""


@REGISTRY.add("poi_normalize", f"WITH {ELEMENT_SQL} SELECT * FROM base ORDER BY category, lower(coalesce(name, '~')), osm_type, osm_id")
def poi_normalize(spark, sf):
    return P.in_base_order(P.normalize_elements(elements(spark, sf)))


@REGISTRY.add("poi_report", f"""
WITH {ELEMENT_SQL} SELECT CASE WHEN grouping(category) = 1 THEN 'TOTAL' ELSE category END AS category, count(*) AS n,
count(name) AS named, count(website) AS website, count(addr) AS addr FROM base GROUP BY GROUPING SETS ((category), ())""")
def poi_report(spark, sf):
    return R.poi_report(P.normalize_elements(elements(spark, sf)))


@REGISTRY.add("poi_subtypes", f"WITH {ELEMENT_SQL} SELECT category, subtype, count(*) AS n FROM base GROUP BY category, subtype")
def poi_subtypes(spark, sf):
    return R.subtype_report(P.normalize_elements(elements(spark, sf)))


INDEX_RULES = replace(PlaceRules(), expansion=("NATION_1", "NATION_3", "NATION_5", "NATION_7", "north side"),
                      split_names=SPLIT, split_label="north side")


def _extras(spark, sf):
    k = F.col("s_suppkey")
    lat, lon = point("s_suppkey", 97)
    return table(spark, sf, "supplier").filter(k % 3 == 0).select(
        k.alias("pos"), F.concat(F.lit("extra "), (k % 4).cast("string")).alias("name"), F.lit("grocery").alias("category"),
        F.lit("deli").alias("subtype"), F.lit("").alias("addr"), lat.alias("lat"), lon.alias("lon"),
        F.lit(2).alias("price"), F.lit("pick").alias("verdict"), F.lit("extra note").alias("notes"))


def _city(spark, sf):
    k = F.col("c_custkey")
    lat, lon = point("c_custkey", 983)
    none = F.lit(None).cast("string")
    return table(spark, sf, "customer").select(
        k.alias("pos"), F.when(k % 13 != 0, F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string"))).alias("name"),
        F.lit("cafe").alias("category"), F.lit("cafe").alias("subtype"), none.alias("cuisine"),
        F.when(k % 2 == 0, F.concat(k.cast("string"), F.lit(" Main St"))).alias("addr"), lat.alias("lat"), lon.alias("lon"),
        none.alias("opening_hours"), none.alias("website"), none.alias("phone"))


@REGISTRY.add("place_index", f"""
WITH RECURSIVE {ELEMENT_SQL},
pts AS (
  SELECT 0 AS source, pos::BIGINT AS pos, name, category, subtype, coalesce(local_addr, '') AS addr, lat, lon FROM raw
  WHERE name IS NOT NULL AND subtype <> 'florist'
  UNION ALL SELECT 1, s_suppkey, 'extra ' || (s_suppkey % 4), 'grocery', 'deli', '', {point_sql('s_suppkey', 97)} FROM supplier WHERE s_suppkey % 3 = 0
  UNION ALL SELECT 2, c_custkey, 'Nation_' || c_nationkey, 'cafe', 'cafe', CASE WHEN c_custkey % 2 = 0 THEN c_custkey || ' Main St' ELSE '' END,
    {point_sql('c_custkey', 983)} FROM customer WHERE c_custkey % 13 <> 0),
{LABEL_SQL},
src AS (SELECT * FROM labelled WHERE source <> 2 OR neighborhood IN ('{"', '".join(INDEX_RULES.expansion)}')),
{greedy_sql('src', 'source, pos')},
placed AS (SELECT source, pos, name, addr, category, lat, lon, neighborhood, first_of_name FROM kept
  UNION ALL SELECT source, pos, name, addr, category, lat, lon, neighborhood, true FROM src WHERE source = 1
    AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.source = 1 AND k.pos = src.pos)),
o AS (SELECT {norm_sql('lower(n_name)')} AS norm, n_regionkey AS price,
  CASE WHEN n_nationkey % 4 = 0 THEN CASE WHEN n_nationkey % 3 = 0 THEN 'pick' ELSE 'ok' END END AS verdict FROM nation WHERE n_nationkey % 2 = 0)
SELECT source, pos, {KEY_SQL} AS key, category, neighborhood,
  greatest(1, round_even({metres_sql(f'{HOME[0]}::DOUBLE', f'({HOME[1]}::DOUBLE)', 'lat', 'lon')} / 80, 0)::INT) AS walkMin,
  CASE WHEN source = 1 THEN lat ELSE round_even(lat, 5)::DOUBLE END AS lat,
  CASE WHEN source = 1 THEN 2 ELSE o.price END AS price, CASE WHEN source = 1 THEN 'pick' ELSE o.verdict END AS verdict
FROM placed LEFT JOIN o ON {norm_sql('placed.name')} = o.norm""")
def place_index(spark, sf):
    built = plan.build(elements(spark, sf), _extras(spark, sf), _city(spark, sf), _overrides(spark, sf),
                       polygons(spark, sf), split_line(spark, sf), INDEX_RULES)
    return built.select("seq.source", F.col("seq.pos.row").alias("pos"), "key", "category", "neighborhood", "walkMin", "lat", "price", "verdict")


def _layers(spark, sf):
    places = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_custkey").alias("k"))
    orders = table(spark, sf, "orders")
    risk = (orders.filter(F.col("o_custkey") % 3 != 0).groupBy(F.col("o_custkey").cast("string").alias("key"))
            .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("violent")))
    conf = F.when(F.col("o_custkey") % 3 == 0, "none").when(F.col("o_custkey") % 3 == 1, "name-only").otherwise("name+address")
    inspections = (orders.groupBy(F.col("o_custkey").cast("string").alias("key"), conf.alias("match_confidence"))
                   .agg(F.count(F.lit(1)).alias("inspections_total")))
    menus = places.filter("k % 4 = 0").select(
        F.col("key").alias("name"), F.concat(F.lit("m"), "key").alias("menu_url"), (F.col("k") % 7).alias("items_count"),
        F.when(F.col("k") % 8 == 0, "ok").when(F.col("k") % 12 == 0, "not_found").otherwise("partial").alias("status"),
        F.concat(F.lit("slug-"), "key").alias("slug"))
    products = places.filter("k % 16 = 0").select(
        F.col("key").alias("name"), F.concat(F.lit("p"), "key").alias("source_url"), (F.col("k") % 5).alias("items_count"),
        F.lit("ok").alias("status"), F.concat(F.lit("store-"), "key").alias("slug"))
    return places, risk, inspections, menus, products


@REGISTRY.add("layer_merge", """
WITH r AS (SELECT o_custkey AS k, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS violent FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1),
i AS (SELECT o_custkey AS k, CASE o_custkey % 3 WHEN 1 THEN 'name-only' ELSE 'name+address' END AS conf, count(*) AS n
  FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1, 2)
SELECT c_custkey::VARCHAR AS key, total AS risk_total, violent AS risk_violent, conf AS match_confidence, n AS inspections_total,
  CASE WHEN c_custkey % 16 = 0 THEN 'p' || c_custkey WHEN c_custkey % 8 = 0 OR (c_custkey % 4 = 0 AND c_custkey % 12 <> 0) THEN 'm' || c_custkey END AS menu_url,
  CASE WHEN c_custkey % 16 = 0 THEN c_custkey % 5 WHEN c_custkey % 8 = 0 OR (c_custkey % 4 = 0 AND c_custkey % 12 <> 0) THEN c_custkey % 7 END AS menu_items,
  CASE WHEN c_custkey % 16 = 0 THEN 'products' WHEN c_custkey % 8 = 0 OR (c_custkey % 4 = 0 AND c_custkey % 12 <> 0) THEN 'menu' END AS menu_kind
FROM customer LEFT JOIN r ON r.k = c_custkey LEFT JOIN i ON i.k = c_custkey""")
def layer_merge(spark, sf):
    out = plan.merge_layers(*_layers(spark, sf))
    return out.select("key", F.col("risk.total").alias("risk_total"), F.col("risk.violent").alias("risk_violent"),
                      "inspection.match_confidence", "inspection.inspections_total", F.col("menu_data.url").alias("menu_url"),
                      F.col("menu_data.items").alias("menu_items"), F.col("menu_data.kind").alias("menu_kind"))


def _covered(spark, sf):
    merged = plan.merge_layers(*_layers(spark, sf))
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("key"), F.when(F.col("c_nationkey") % 6 != 0, F.col("n_name")).alias("neighborhood"),
        F.when(F.col("c_mktsegment") == "BUILDING", "restaurant").when(F.col("c_mktsegment") == "MACHINERY", "cafe")
        .otherwise("grocery").alias("category"), (F.col("c_custkey") % 29 + 1).alias("walkMin"))
    status = F.when(F.col("k") % 4 == 0, F.when(F.col("k") % 8 == 0, "ok").when(F.col("k") % 12 == 0, "not_found").otherwise("partial"))
    return c.join(merged, "key").select(
        "*", F.col("risk").isNotNull().alias("has_risk"), F.col("inspection.match_confidence").alias("match_confidence"),
        status.alias("menu_status"), F.col("menu_data").isNotNull().alias("has_menu"), F.col("inspection").isNotNull().alias("has_inspection"))


_COVER_SQL = """
o AS (SELECT DISTINCT o_custkey FROM orders),
c AS (SELECT coalesce(CASE WHEN c_nationkey % 6 <> 0 THEN n_name END, '(none)') AS neighborhood,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'restaurant' WHEN 'MACHINERY' THEN 'cafe' ELSE 'grocery' END AS category,
  c_custkey % 29 + 1 AS walk, o_custkey IS NOT NULL AND c_custkey % 3 <> 0 AS layered, c_custkey % 3 AS m,
  CASE WHEN c_custkey % 8 = 0 THEN 'ok' WHEN c_custkey % 12 = 0 THEN 'not_found' WHEN c_custkey % 4 = 0 THEN 'partial' END AS menu,
  c_custkey % 16 = 0 OR c_custkey % 8 = 0 OR (c_custkey % 4 = 0 AND c_custkey % 12 <> 0) AS has_menu
  FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN o ON o_custkey = c_custkey)"""


@REGISTRY.add("coverage_rollup", f"""
WITH {_COVER_SQL}
SELECT CASE WHEN grouping(neighborhood) = 1 THEN 'TOTAL' ELSE neighborhood END AS neighborhood, count(*) AS places,
  count(*) FILTER (category = 'restaurant') AS restaurant, count(*) FILTER (category = 'cafe') AS cafe,
  count(*) FILTER (category = 'grocery') AS grocery, min(walk) AS walk_min, max(walk) AS walk_max,
  count(*) FILTER (layered) AS with_risk, count(*) FILTER (layered) AS with_inspection,
  count(*) FILTER (layered AND m = 2) AS with_address_match, count(menu) AS menus_tried,
  count(*) FILTER (menu = 'ok') AS ok, count(*) FILTER (menu = 'partial') AS partial,
  count(*) FILTER (menu = 'not_found') AS not_found, count(*) FILTER (menu = 'skipped') AS skipped
FROM c GROUP BY GROUPING SETS ((neighborhood), ())""")
def coverage_rollup(spark, sf):
    return R.in_display_order(R.coverage(_covered(spark, sf)), "neighborhood")


@REGISTRY.add("area_summary", f"""
WITH {_COVER_SQL} SELECT CASE WHEN neighborhood = '(none)' THEN NULL ELSE neighborhood END AS neighborhood, count(*) AS places, max(walk) AS walk_max, count(*) FILTER (has_menu) AS has_menu,
count(*) FILTER (layered) AS has_inspection, count(*) FILTER (layered) AS has_risk FROM c GROUP BY 1""")
def area_summary(spark, sf):
    return R.area_summary(_covered(spark, sf))


@REGISTRY.add("menu_coverage", f"""
WITH {_COVER_SQL} SELECT count(*) AS places, count(*) FILTER (menu IN ('ok', 'partial')) AS with_menu, count(menu) AS attempted
FROM c WHERE category IN ('restaurant', 'cafe')""")
def menu_coverage(spark, sf):
    return R.menu_coverage(_covered(spark, sf))



@REGISTRY.add("extra_points", f"""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN s.lat ELSE c_custkey / 1000.0::DOUBLE END AS lat, CASE WHEN c_custkey % 3 = 0 THEN s.lon ELSE 1.0::DOUBLE END AS lon
FROM customer LEFT JOIN (SELECT s_suppkey, {point_sql('s_suppkey')} FROM supplier) s ON s.s_suppkey = c_custkey""")
def extra_points(spark, sf):
    """Customers without a point take the one of the supplier of the same number."""
    k = F.col("c_custkey")
    lat, lon = point("s_suppkey")
    places = table(spark, sf, "customer").select("c_custkey", k.cast("string").alias("name"), F.when(k % 3 != 0, k / 1000).alias("lat"), F.when(k % 3 != 0, 1.0).alias("lon"))
    extras = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("name"), lat.alias("lat"), lon.alias("lon"))
    return plan.with_extra_points(places, extras).select("c_custkey", "lat", "lon")


@REGISTRY.add("text_scalars", f"""
SELECT doc_id, {norm_sql("text")} AS norm,
  coalesce(nullif(trim(regexp_replace(lower({r"regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')"}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'x') AS slug,
  substring(sha256(text), 1, 20) AS text_hash,
  substring(sha256('{{"battery":"b","model":"' || lang || '","sampling":"s"}}'), 1, 12) AS basis
FROM documents""")
def text_scalars(spark, sf):
    from larderline.plans.readings import basis_hash
    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", X.normal_name(t).alias("norm"), X.slug(t).alias("slug"), X.text_hash(t).alias("text_hash"),
        basis_hash(F.col("lang"), F.lit("b"), F.lit("s")).alias("basis"))
