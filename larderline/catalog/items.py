"""Item table, packages, prices and manifests on parts, suppliers and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from larderline.catalog.base import Registry, table
from larderline.config import PackageRules
from larderline.operators import items as I
from larderline.operators import reports as R

REGISTRY = Registry()


def item_rows(spark, sf):
    """Parts as menu items and suppliers as store products, in one item schema."""
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    blank = F.lit("")
    fixed = [F.lit("list").alias("source"), F.lit("2024-01-01").alias("as_of"), F.lit("ok").alias("status")]
    menu = table(spark, sf, "part").select(
        F.col("p_brand").alias("place"), F.lit("menu").alias("kind"), F.col("p_type").alias("section"), F.col("p_name").alias("name"),
        F.when(k % 5 == 0, "big").otherwise("").alias("description"), blank.alias("size"),
        F.when(k % 9 != 0, F.col("p_retailprice")).alias("price"), *fixed, k.alias("pos"))
    product = table(spark, sf, "supplier").select(
        F.concat(F.lit("Store No. "), F.col("s_nationkey").cast("string")).alias("place"), F.lit("product").alias("kind"),
        F.lit("Shelf / A").alias("section"), F.concat(F.lit("Item #"), (s % 3).cast("string")).alias("name"), blank.alias("description"),
        F.concat_ws(" ", (s % 4).cast("string"), F.lit("Oz")).alias("size"), F.col("s_acctbal").alias("price"), *fixed, s.alias("pos"))
    return menu.unionByName(product)


def _slug_sql(c: str) -> str:
    return f"coalesce(nullif(trim(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'x')"


ITEM_SQL = f"""
src AS (SELECT p_brand AS place, 'menu' AS kind, p_type AS section, p_name AS name, CASE WHEN p_partkey % 5 = 0 THEN 'big' ELSE '' END AS description,
  '' AS size, CASE WHEN p_partkey % 9 <> 0 THEN p_retailprice END AS price, p_partkey AS pos FROM part
  UNION ALL SELECT 'Store No. ' || s_nationkey, 'product', 'Shelf / A', 'Item #' || (s_suppkey % 3), '', (s_suppkey % 4) || ' Oz', s_acctbal, s_suppkey FROM supplier),
based AS (SELECT *, {_slug_sql('place')} || '--' || {_slug_sql('name')} AS base FROM src),
item AS (SELECT *, base || CASE WHEN n = 1 THEN '' ELSE '-' || n END AS id FROM (SELECT *, row_number() OVER (
  PARTITION BY base ORDER BY section, description, size, coalesce(price, -1), name, kind, pos) AS n FROM based))
"""


@REGISTRY.add("item_ids", f"WITH {ITEM_SQL} SELECT id, place, kind, section, name, description, size, price FROM item")
def item_ids(spark, sf):
    return I.with_ids(item_rows(spark, sf)).drop("source", "as_of", "status")


@REGISTRY.add("item_id_collisions", f"WITH {ITEM_SQL} SELECT id, count(*) AS copies FROM item GROUP BY id HAVING count(*) > 1")
def item_id_collisions(spark, sf):
    from larderline.operators.dedup import duplicates
    return duplicates(I.with_ids(item_rows(spark, sf)), ["id"])


DOCUMENT_SQL = f"""
src AS (SELECT p_brand AS place, 'menu' AS kind, p_type AS section, p_name AS name, CASE WHEN p_partkey % 5 = 0 THEN 'big' ELSE '' END AS description,
  '' AS size, CASE WHEN p_partkey % 9 <> 0 THEN p_retailprice END AS price, 'list ' || lpad((p_partkey // 50)::VARCHAR, 12, '0') AS source, p_partkey AS pos FROM part
  UNION ALL SELECT 'Store No. ' || s_nationkey, 'product', 'Shelf / A', 'Item #' || (s_suppkey % 3), '', CASE WHEN s_suppkey % 2 = 0 THEN (s_suppkey % 4) || ' Oz' ELSE '' END, s_acctbal,
  'list ' || lpad((s_suppkey // 50)::VARCHAR, 12, '0'), s_suppkey FROM supplier),
based AS (SELECT *, {_slug_sql('place')} || '--' || {_slug_sql('name')} AS base FROM src)
"""


@REGISTRY.add("item_table", f"""
WITH {DOCUMENT_SQL}
SELECT base || CASE WHEN n = 1 THEN '' ELSE '-' || n END AS id, place, kind, section, name, description, size, price, source, '2024-01-01' AS as_of, 'ok' AS status
FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY section, description, size, coalesce(price, -1), name, kind, source, pos) AS n FROM based)""")
def item_table(spark, sf):
    """Menu documents of parts and product documents of suppliers, at most 50 items each, as one item table with ids."""
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    source = lambda c: F.concat(F.lit("list "), F.lpad(F.floor(c / 50).cast("string"), 12, "0"))

    def documents(rows, name, key, items, item):
        listed = F.transform(F.array_sort(F.collect_list(F.struct(key.alias("o"), item.alias("i")))), lambda x: x["i"])
        return rows.groupBy(name.alias("name"), source(key).alias("source")).agg(listed.alias(items)).withColumns({"as_of": F.lit("2024-01-01"), "status": F.lit("ok")})

    menus = documents(table(spark, sf, "part"), F.col("p_brand"), k, "items", F.struct(
        F.col("p_type").alias("section"), F.col("p_name").alias("item"), F.when(k % 5 == 0, "big").alias("description"), F.when(k % 9 != 0, F.col("p_retailprice")).alias("price")))
    products = documents(table(spark, sf, "supplier"), F.concat(F.lit("Store No. "), F.col("s_nationkey").cast("string")), s, "products", F.struct(
        F.lit("Shelf / A").alias("section"), F.concat(F.lit("Item #"), (s % 3).cast("string")).alias("name"), F.lit(None).cast("string").alias("description"),
        F.when(s % 2 == 0, F.concat_ws(" ", (s % 4).cast("string"), F.lit("Oz"))).alias("size"), F.col("s_acctbal").alias("price")))
    return I.with_ids(I.menu_items(menus).unionByName(I.product_items(products)))


_UNITS = {"MEDIUM": "Oz", "PROMO": "lb", "STANDARD": "Fl Oz", "LARGE": "Each", "SMALL": "Doz", "ECONOMY": "Bunch"}


def _sized(spark, sf):
    unit = F.create_map(*[F.lit(x) for kv in _UNITS.items() for x in kv])[F.col("p_type")]
    amount = (F.col("p_size") / 4).cast("string")
    return table(spark, sf, "part").select("p_partkey", F.concat(F.lit(" "), amount, F.lit(" "), unit).alias("size"))


@REGISTRY.add("package_facts", """
WITH s AS (SELECT p_partkey, p_type, p_size / 4.0::DOUBLE AS n FROM part)
SELECT p_partkey, CASE p_type WHEN 'MEDIUM' THEN 'weight' WHEN 'PROMO' THEN 'weight' WHEN 'STANDARD' THEN 'volume' WHEN 'LARGE' THEN 'each' WHEN 'SMALL' THEN 'count' END AS sold_by,
  CASE p_type WHEN 'MEDIUM' THEN round_even(n * 28.349523125::DOUBLE, 1)::DOUBLE WHEN 'PROMO' THEN round_even(n * 453.59237::DOUBLE, 1)::DOUBLE END AS package_g,
  CASE p_type WHEN 'STANDARD' THEN round_even(n * 29.5735295625::DOUBLE, 1)::DOUBLE END AS package_ml,
  CASE p_type WHEN 'LARGE' THEN round_even(n, 0)::INT WHEN 'SMALL' THEN round_even(n * 12, 0)::INT END AS units FROM s""")
def package_facts(spark, sf):
    return I.with_package_facts(_sized(spark, sf)).drop("size")


def _pull(spark, sf):
    k = F.col("p_partkey")
    path = (F.when(k % 6 == 0, "Flowers & Plants>Roses").when(k % 6 == 1, "Food>Bakery>Bread").when(k % 6 == 2, "Food>")
            .when(k % 6 == 3, "Beverages>Tea").otherwise(F.concat(F.lit("Food> "), F.col("p_type"), F.lit("  > x"))))
    return table(spark, sf, "part").select(
        k.alias("ord"), (k % 700).cast("string").alias("sku"), F.concat(F.lit("\u00a0\t "), F.replace("p_name", F.lit(" "), F.lit(" \u00a0")), F.lit("\n")).alias("title"),
        F.when(k % 8 != 0, F.col("p_retailprice")).alias("price"), (F.col("p_size") * F.when(k % 7 == 0, 98765.4321).when(k % 7 == 1, 0.0000123).otherwise(1 / 7)).alias("quantity"),
        F.when(k % 5 == 0, "Oz").when(k % 5 == 1, "Each").alias("unit"), path.alias("path"))


@REGISTRY.add("product_normalize", """
WITH r AS (SELECT p_partkey AS ord, p_partkey % 700 AS sku, trim(p_name) AS name, CASE WHEN p_partkey % 8 <> 0 THEN p_retailprice END AS price, p_size * CASE p_partkey % 7 WHEN 0 THEN 98765.4321::DOUBLE WHEN 1 THEN 0.0000123::DOUBLE ELSE 1 / 7.0::DOUBLE END AS n,
  CASE p_partkey % 5 WHEN 0 THEN 'Oz' WHEN 1 THEN 'Each' ELSE '' END AS unit,
  CASE p_partkey % 6 WHEN 1 THEN 'Bakery / Bread' WHEN 2 THEN 'Uncategorized' WHEN 3 THEN 'Beverages / Tea' ELSE ' ' || p_type || '  /  x' END AS section
  FROM part WHERE p_partkey % 6 <> 0),
s AS (SELECT *, printf('%g', n) AS shown FROM r), f AS (SELECT * REPLACE (CASE WHEN shown NOT LIKE '%e%' THEN shown::DOUBLE END AS n) FROM s QUALIFY row_number() OVER (PARTITION BY sku ORDER BY ord) = 1)
SELECT section, name, '' AS description, trim(shown || ' ' || unit) AS size, price,
  CASE WHEN n IS NOT NULL THEN CASE unit WHEN 'Oz' THEN 'weight' WHEN 'Each' THEN 'each' END END AS sold_by, CASE unit WHEN 'Oz' THEN round_even(n * 28.349523125::DOUBLE, 1)::DOUBLE END AS package_g,
  NULL::DOUBLE AS package_ml, CASE unit WHEN 'Each' THEN round_even(n, 0)::INT END AS units FROM f""")
def product_normalize(spark, sf):
    return I.in_shelf_order(I.products_from_pull(_pull(spark, sf), PackageRules()))


@REGISTRY.add("manifest", """
SELECT o_orderkey, o_orderstatus AS status, count(l_orderkey) AS items_count FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def manifest(spark, sf):
    docs = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return I.manifest_from_rows(docs, lines, "o_orderkey")


def _documents(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("items"), F.count_if(F.col("l_discount") > 0.02).alias("priced"))
    zero = F.lit(0)
    return table(spark, sf, "orders").join(lines, "o_orderkey", "left").select(
        F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("as_of"),
        F.coalesce("items", zero).alias("items"), F.coalesce("priced", zero).alias("priced"),
        F.when(F.col("o_orderkey") % 3 != 0, (F.col("o_orderkey") % 4) + 1).alias("level"))


@REGISTRY.add("menu_report", """
WITH l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_discount > 0.02::DOUBLE) AS priced FROM lineitem GROUP BY 1)
SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN 'TOTAL' ELSE o_orderstatus END AS status, count(*) AS documents,
  coalesce(sum(n), 0)::BIGINT AS items, coalesce(sum(priced), 0)::BIGINT AS priced, min(strftime(o_orderdate, '%Y-%m-%d')) AS first_as_of,
  max(strftime(o_orderdate, '%Y-%m-%d')) AS last_as_of FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY GROUPING SETS ((o_orderstatus), ())""")
def menu_report(spark, sf):
    return R.menu_report(_documents(spark, sf))


@REGISTRY.add("level_report", """
SELECT o_orderkey % 4 + 1 AS level, count(*) AS documents FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1""")
def level_report(spark, sf):
    return R.level_report(_documents(spark, sf), "level")


@REGISTRY.add("price_level", """
WITH p AS (SELECT l_orderkey, median(l_extendedprice / 2000) AS m FROM lineitem GROUP BY 1)
SELECT l_orderkey, round(m, 8) AS median_price, CASE WHEN m < 10 THEN 1 WHEN m < 18 THEN 2 WHEN m < 30 THEN 3 ELSE 4 END AS price_level FROM p""")
def price_level(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", (F.col("l_extendedprice") / 2000).alias("price"), "l_linenumber")
    out = I.median_price(lines, "l_orderkey", "price", "l_linenumber")
    return out.select("l_orderkey", F.round("median_price", 8).alias("median_price"),
                      I.price_level(F.col("median_price")).alias("price_level"))


@REGISTRY.add("dataset_profile", """
SELECT 'events' AS dataset, count(*) AS rows, min(strftime(ts, '%Y-%m-%d')) AS date_min, max(strftime(ts, '%Y-%m-%d')) AS date_max,
  max(strftime(ts, '%Y-%m-%d')) FILTER (strftime(ts, '%Y-%m-%d') <= '2024-01-20') AS date_max_not_after_today,
  count(*) FILTER (strftime(ts, '%Y-%m-%d') > '2024-01-20') AS future_dated_rows FROM events
UNION ALL SELECT 'orders', count(*), min(strftime(o_orderdate, '%Y-%m-%d')), max(strftime(o_orderdate, '%Y-%m-%d')),
  max(strftime(o_orderdate, '%Y-%m-%d')) FILTER (strftime(o_orderdate, '%Y-%m-%d') <= '2024-01-20'), 0 FROM orders""")
def dataset_profile(spark, sf):
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return R.dataset_profile(table(spark, sf, "events"), "events", text("ts"), "2024-01-20").unionByName(
        R.dataset_profile(table(spark, sf, "orders"), "orders", text("o_orderdate"), "2024-01-20"))


@REGISTRY.add("dataset_range", """
SELECT min(strftime(o_orderdate, '%Y-%m-%d')) AS date_min, max(strftime(ts, '%Y-%m-%d')) FILTER (strftime(ts, '%Y-%m-%d') <= '2024-01-20') AS date_max
FROM (SELECT o_orderdate, NULL::TIMESTAMP AS ts FROM orders UNION ALL SELECT NULL, ts FROM events)""")
def dataset_range(spark, sf):
    return R.dataset_range(dataset_profile(spark, sf))


@REGISTRY.add("local_dates", "SELECT event_id, strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d') AS day FROM events")
def local_dates(spark, sf):
    """Calendar date of each event in a zone eight hours behind."""
    instant = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return table(spark, sf, "events").select("event_id", I.local_date(instant, "Etc/GMT+8").cast("string").alias("day"))
