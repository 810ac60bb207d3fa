"""Quality rules on orders, lines, customers, documents and pages."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from larderline.catalog import foods, readings
from larderline.catalog.base import Registry, table
from larderline.config import FreshnessRules, NutrientRules, VerdictRules
from larderline.functions.text import item_text, text_hash
from larderline.operators import quality as Q
from larderline.plans import quality as plan
from larderline.session import cut

REGISTRY = Registry()
TODAY = "1998-06-15"


@REGISTRY.add("freshness", f"""
WITH d AS (SELECT o_orderkey AS k, o_orderdate::DATE + 180 AS due, o_custkey % 5 <> 0 AS has_rows, CASE WHEN o_custkey % 7 = 0 THEN o_orderdate::DATE + 400 END AS until FROM orders),
s AS (SELECT *, DATE '{TODAY}' > due AS stale, DATE '{TODAY}' >= due - 30 AS soon, coalesce(until >= DATE '{TODAY}', false) AS held FROM d WHERE has_rows)
SELECT 'freshness' AS rule, CASE WHEN stale AND NOT held THEN 'fail' ELSE 'warn' END AS severity, k::VARCHAR AS key,
  'due ' || CASE WHEN stale AND held THEN until ELSE due END AS detail FROM s WHERE stale OR soon""")
def freshness(spark, sf):
    o = table(spark, sf, "orders")
    day = lambda n: F.date_add(F.to_date("o_orderdate"), n).cast("string")
    docs = o.select(F.col("o_orderkey").cast("string").alias("slug"), day(0).alias("as_of"), (F.col("o_custkey") % 5).alias("rows"))
    longer = o.filter(F.col("o_custkey") % 7 == 0).select(F.col("o_orderkey").cast("string").alias("slug"), day(400).alias("until"))
    return Q.freshness(docs, TODAY, longer, FreshnessRules())


@REGISTRY.add("date_window", f"""
WITH d AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate::DATE END AS due FROM orders)
SELECT 'review' AS rule, CASE WHEN due IS NULL OR DATE '{TODAY}' > due THEN 'fail' ELSE 'warn' END AS severity, k::VARCHAR AS key,
  CASE WHEN due IS NULL THEN 'no valid date' WHEN DATE '{TODAY}' > due THEN 'past ' || due ELSE 'due ' || due END AS detail
FROM d WHERE due IS NULL OR DATE '{TODAY}' >= due - 30""")
def date_window(spark, sf):
    due = F.when(F.col("o_orderkey") % 50 == 0, "soon").otherwise(F.to_date("o_orderdate").cast("string"))
    return Q.date_window(table(spark, sf, "orders").select("o_orderkey", due.alias("due")), "review", "o_orderkey", "due", TODAY, 30)


@REGISTRY.add("verdict_rules", f"""
WITH e AS (SELECT o_orderkey AS k, CASE o_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'pick' WHEN 2 THEN 'ok' WHEN 3 THEN 'treat' ELSE 'great' END AS v,
  CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate::DATE END AS d, o_orderpriority = '1-URGENT' AS ex FROM orders),
s AS (SELECT *, d + 365 AS due FROM e WHERE v IS NOT NULL)
SELECT 'verdict' AS rule, CASE WHEN v = 'great' THEN 'fail' WHEN d IS NULL THEN CASE WHEN ex THEN 'warn' ELSE 'fail' END WHEN DATE '{TODAY}' > due THEN 'fail' ELSE 'warn' END AS severity,
  key AS key, CASE WHEN v = 'great' THEN 'verdict great' WHEN d IS NULL AND ex THEN 'no date, exempt until 1999-01-01' WHEN d IS NULL THEN 'no date' ELSE 'review due ' || due END AS detail
FROM (SELECT *, CASE WHEN ex THEN '1-URGENT' ELSE k::VARCHAR END AS key FROM s) WHERE v = 'great' OR d IS NULL OR DATE '{TODAY}' >= due - 30""")
def verdict_rules(spark, sf):
    k = F.col("o_custkey") % 5
    urgent = F.col("o_orderpriority") == "1-URGENT"
    entries = table(spark, sf, "orders").select(
        F.when(urgent, "1-URGENT").otherwise(F.col("o_orderkey").cast("string")).alias("name"),
        F.when(k == 1, "pick").when(k == 2, "ok").when(k == 3, "treat").when(k == 4, "great").alias("verdict"),
        F.when(F.col("o_orderkey") % 9 == 0, "summer").otherwise(F.to_date("o_orderdate").cast("string")).alias("verified"))
    return Q.verdicts(entries, TODAY, replace(VerdictRules(), undated_until={"1-URGENT": "1999-01-01"}))


@REGISTRY.add("verdict_travels", f"""
SELECT 'verdict-travels-dated' AS rule, 'fail' AS severity, c_custkey::VARCHAR AS key, 'verdict without a dated ruling' AS detail FROM customer
WHERE c_mktsegment <> 'BUILDING' AND c_nationkey % 3 = 0""")
def verdict_travels(spark, sf):
    places = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), F.when(F.col("c_mktsegment") != "BUILDING", "ok").alias("verdict"),
        F.when(F.col("c_nationkey") % 3 != 0, "1998-01-01").alias("verified"))
    return Q.undated_place_verdicts(places, TODAY)


@REGISTRY.add("layer_integrity", """
WITH pl AS (SELECT c_custkey AS key, c_nationkey % 6 <> 0 AS has_area FROM customer WHERE c_custkey % 7 <> 0 UNION ALL SELECT c_custkey, true FROM customer WHERE c_custkey % 100 = 1),
ri AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderstatus = 'F'), ins AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderstatus = 'O')
SELECT 'duplicate-key' AS rule, 'fail' AS severity, key::VARCHAR AS key, count(*) || ' places' AS detail FROM pl GROUP BY key HAVING count(*) > 1
UNION ALL SELECT 'place-without-area', 'fail', 'n' || key, 'no neighborhood' FROM pl WHERE NOT has_area
UNION ALL SELECT 'orphan-risk', 'fail', key::VARCHAR, 'matches no place' FROM ri WHERE key NOT IN (SELECT key FROM pl)
UNION ALL SELECT DISTINCT 'place-without-risk', 'fail', key::VARCHAR, 'no risk row' FROM pl WHERE key NOT IN (SELECT key FROM ri)
UNION ALL SELECT 'orphan-inspection', 'fail', key::VARCHAR, 'matches no place' FROM ins WHERE key NOT IN (SELECT key FROM pl)
UNION ALL SELECT 'place-without-key', 'fail', 's' || s_suppkey, 'no key' FROM supplier WHERE s_suppkey % 40 = 0""")
def layer_integrity(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    row = lambda df, area: df.select(k.alias("key"), F.concat(F.lit("n"), k.cast("string")).alias("name"), area.alias("neighborhood"))
    places = row(c.filter(k % 7 != 0), F.when(F.col("c_nationkey") % 6 != 0, "area")).unionByName(row(c.filter(k % 100 == 1), F.lit("area")))
    keyless = table(spark, sf, "supplier").filter(F.col("s_suppkey") % 40 == 0).select(
        F.lit(None).cast("bigint").alias("key"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("name"), F.lit("area").alias("neighborhood"))
    orders = table(spark, sf, "orders")
    layer = lambda s: orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("key"))
    return Q.layer_keys(places.unionByName(keyless), layer("F"), layer("O"))


@REGISTRY.add("duplicate_lines", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_lines(spark, sf):
    from larderline.operators.dedup import duplicates
    return duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_BOUNDS = NutrientRules().bounds


@REGISTRY.add("nutrient_bounds", f"""
WITH b AS (SELECT row_number() OVER () AS r, l_orderkey AS food, l_quantity * 20 AS energy_kcal, l_quantity * 2.5::DOUBLE AS protein_g, l_discount * 1200 AS fat_g, l_tax * 1000 - 5 AS carbohydrate_g, l_extendedprice AS sodium_mg FROM lineitem),
u AS (SELECT food, 'energy_kcal' AS field, energy_kcal AS value FROM b WHERE NOT energy_kcal BETWEEN 0 AND 902
  UNION ALL SELECT food, 'protein_g', protein_g FROM b WHERE NOT protein_g BETWEEN 0 AND 100 UNION ALL SELECT food, 'fat_g', fat_g FROM b WHERE NOT fat_g BETWEEN 0 AND 100
  UNION ALL SELECT food, 'carbohydrate_g', carbohydrate_g FROM b WHERE NOT carbohydrate_g BETWEEN 0 AND 100 UNION ALL SELECT food, 'sodium_mg', sodium_mg FROM b WHERE NOT sodium_mg BETWEEN 0 AND 40000
  UNION ALL SELECT food, 'sum', protein_g + fat_g + carbohydrate_g FROM b WHERE protein_g + fat_g + carbohydrate_g > 105)
SELECT food, field, round(value, 6) AS value FROM u""")
def nutrient_bounds(spark, sf):
    null = F.lit(None).cast("double")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("food"), (F.col("l_quantity") * 20).alias("energy_kcal"), (F.col("l_quantity") * 2.5).alias("protein_g"),
        (F.col("l_discount") * 1200).alias("fat_g"), (F.col("l_tax") * 1000 - 5).alias("carbohydrate_g"), F.col("l_extendedprice").alias("sodium_mg"),
        null.alias("fiber_g"), null.alias("sugars_g"), null.alias("saturated_fat_g"))
    return Q.nutrient_bounds(rows, "food").withColumn("value", F.round("value", 6))


def _witnessed(spark, sf):
    pairs = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("p"), F.max("l_quantity").alias("q"))
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    values = pairs.select(k.alias("fdcId"), F.lit("energy_kcal").alias("field"), n.alias("nid"),
                          F.when((k + n) % 10 != 0, F.col("p") / 100 + F.col("q") / 1000).alias("value"))
    copies = pairs.filter((k % 3 != 0) & ((k + n) % 8 != 0)).select(k.alias("fdcId"), n.alias("nid"), (F.floor(F.col("p")) / 100).alias("amount"))
    return values, copies


@REGISTRY.add("witness_check", """
WITH p AS (SELECT l_orderkey AS k, l_linenumber AS n, max(l_extendedprice) AS p, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
v AS (SELECT k, n, p / 100 + q / 1000 AS value FROM p WHERE (k + n) % 10 <> 0),
c AS (SELECT k, n, floor(p) / 100 AS a, floor(p)::BIGINT AS cents FROM p WHERE k % 3 <> 0 AND (k + n) % 8 <> 0),
j AS (SELECT v.k, v.value, c.a, greatest(0.5 * CASE WHEN cents % 100 = 0 THEN 1 WHEN cents % 10 = 0 THEN 0.1 ELSE 0.01 END, CASE WHEN a = 0 THEN 0 ELSE 0.5 * power(10.0::DOUBLE, floor(log10(a)) - 2) END) + 1e-9 AS tol
  FROM v LEFT JOIN c ON c.k = v.k AND c.n = v.n WHERE v.k IN (SELECT k FROM c))
SELECT 'witness' AS rule, 'fail' AS severity, k || '.energy_kcal' AS key, count(*) AS n FROM j WHERE a IS NULL OR abs(a - value) > tol GROUP BY ALL""")
def witness_check(spark, sf):
    return Q.witness(*_witnessed(spark, sf)).groupBy("rule", "severity", "key").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("bulk_gaps", f"""
WITH {foods.NUTRIENT_SQL}, c(nid) AS (VALUES (1008), (2047), (1063)),
g AS (SELECT fdcId, 'energy_kcal' AS field, 1008 AS nid FROM per WHERE energy_kcal IS NULL AND fdcId % 2 = 0
  UNION ALL SELECT fdcId, 'energy_kcal', 2047 FROM per WHERE energy_kcal IS NULL AND fdcId % 2 = 1
  UNION ALL SELECT fdcId, 'sugars_g', 1063 FROM per WHERE sugars_g IS NULL AND fdcId % 2 = 1)
SELECT 'null-in-bulk' AS rule, 'warn' AS severity, fdcId || '.' || field AS key, 'the copy carries ' || nid AS detail FROM g""")
def bulk_gaps(spark, sf):
    wide = foods.nutrient_table(spark, sf)
    fields = list(_BOUNDS)
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])
    values = wide.select("fdcId", F.explode(pairs).alias("x")).select("fdcId", "x.*")
    held = F.when(F.col("fdcId") % 2 == 0, F.array(F.lit(1008), F.lit(2047))).otherwise(F.array(F.lit(2047), F.lit(1063)))
    copies = wide.select("fdcId", F.explode(held).alias("nid"))
    return Q.bulk_gaps(values, copies)


@REGISTRY.add("record_set", """
WITH m AS (SELECT DISTINCT l_partkey AS k FROM lineitem), r AS (SELECT s_suppkey * 30 AS k FROM supplier)
SELECT 'nutrient-missing' AS rule, 'fail' AS severity, k::VARCHAR AS key, 'mapped, no row' AS detail FROM m WHERE k NOT IN (SELECT k FROM r)
UNION ALL SELECT 'nutrient-extra', 'fail', k::VARCHAR, 'row, not mapped' FROM r WHERE k NOT IN (SELECT k FROM m)""")
def record_set(spark, sf):
    """Records under every thirtieth number against the parts of all lines."""
    wanted = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("fdcId"))
    return Q.record_set(table(spark, sf, "supplier").select((F.col("s_suppkey") * 30).alias("fdcId")), wanted)


@REGISTRY.add("uncached_mappings", """
SELECT 'mapping-without-record' AS rule, 'fail' AS severity, l_orderkey::VARCHAR AS key, l_partkey::VARCHAR AS detail FROM lineitem
WHERE l_partkey NOT IN (SELECT c_custkey FROM customer)""")
def uncached_mappings(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("fdcId"))
    return Q.uncached_mappings(lines, table(spark, sf, "customer").select(F.col("c_custkey").alias("fdcId")), "l_orderkey")


EMAIL = r"[a-z0-9._-]+@[a-z0-9.-]+\.[a-z]+"


@REGISTRY.add("pattern_scan", f"""
WITH t AS (SELECT 'documents/' || doc_id AS path, text FROM documents UNION ALL SELECT 'pages/' || page_id, html FROM pages WHERE page_id % 10 <> 0),
m AS (SELECT path, 'email' AS label, unnest(regexp_extract_all(text, '(?i){EMAIL}')) AS match FROM t
  UNION ALL SELECT path, 'link', unnest(regexp_extract_all(text, '(?i)href="/[a-z]+"')) FROM t)
SELECT path, label, match, count(*) AS n FROM m GROUP BY ALL""")
def pattern_scan(spark, sf):
    docs = table(spark, sf, "documents").select(F.concat(F.lit("documents/"), F.col("doc_id").cast("string")).alias("path"), "text")
    pages = table(spark, sf, "pages").select(
        F.concat(F.when(F.col("page_id") % 10 == 0, "exempt/").otherwise("pages/"), F.col("page_id").cast("string")).alias("path"), F.col("html").alias("text"))
    found = Q.pattern_scan(docs.unionByName(pages), [(EMAIL, "email"), ('href="/[a-z]+"', "link")], exempt=("exempt/",))
    return found.groupBy("path", "label", "match").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("pattern_lines", f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)
SELECT 'documents/' || doc_id AS path, line_no::INT AS line, unnest(regexp_extract_all(line, '(?i){EMAIL}')) AS match FROM l""")
def pattern_lines(spark, sf):
    docs = table(spark, sf, "documents").select(F.concat(F.lit("documents/"), F.col("doc_id").cast("string")).alias("path"), "text")
    return Q.pattern_scan(docs, [(EMAIL, "email")]).select("path", "line", "match")


@REGISTRY.add("derived_equals", """
WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1)
SELECT 'derived-equals' AS rule, 'fail' AS severity, 'stored' AS key, '{"k":' || k || ',"n":' || n || '}' AS detail FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT 'derived-equals', 'fail', 'derived', '{"k":' || k || ',"n":' || n || '}' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def derived_equals(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderstatus")
    count = lambda df: df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return Q.same_rows(count(o.filter("o_orderstatus <> 'P'")), count(o))


@REGISTRY.add("document_shape", """
WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
SELECT 'unknown-place' AS rule, 'fail' AS severity, 'o' || k || '.json' AS key, 'Place ' || (k % 97) AS detail FROM o WHERE k % 97 NOT IN (SELECT c_custkey % 90 FROM customer)
UNION ALL SELECT 'status', 'fail', 'o' || k || '.json', CASE s WHEN 'P' THEN 'pending' END FROM o WHERE s = 'P'
UNION ALL SELECT 'malformed-row', 'fail', 'o' || k || '.json', CASE k % 10 WHEN 1 THEN 'price as text' WHEN 2 THEN 'field missing' WHEN 3 THEN 'blank name' ELSE 'extra field' END FROM o WHERE k % 10 IN (1, 2, 3, 4)
UNION ALL SELECT 'no-extraction-basis', 'fail', 'o' || k || '.json', day FROM o WHERE day >= '1998-01-01' AND k % 5 = 0
UNION ALL SELECT 'script-without-path', 'fail', 'o' || k || '.json', day FROM o WHERE day >= '1998-01-01' AND k % 5 = 1""")
def document_shape(spark, sf):
    """Orders as menu documents with one item, some of them broken in one way."""
    from larderline.config import DocumentRules
    k = F.col("o_orderkey")
    good = '{"section": "s", "item": "i", "price": 2.5, "description": ""}'
    row = (F.when(k % 10 == 1, F.lit(good.replace("2.5", '"2.5"'))).when(k % 10 == 2, F.lit('{"section": "s", "item": "i", "price": 1}'))
           .when(k % 10 == 3, F.lit(good.replace('"i"', '"  "'))).when(k % 10 == 4, F.lit(good.replace("}", ', "x": 1}'))).when(k % 10 == 5, F.lit(good.replace("2.5", "null"))).otherwise(F.lit(good)))
    status = F.when(F.col("o_orderstatus") == "P", "pending").when(F.col("o_orderstatus") == "F", "ok").otherwise("partial")
    basis = (F.when(k % 5 == 0, F.lit('{"method": "model", "model": "m"}')).when(k % 5 == 1, F.lit('{"method": "script"}'))
             .when(k % 5 == 2, F.lit('{"method": "script", "path": "p"}')).otherwise(F.lit('{"model": "m", "prompt_hash": "h"}')))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    doc = F.concat(F.lit('{"name": "Place '), (k % 97).cast("string"), F.lit('", "status": "'), status, F.lit('", "as_of": "'), day, F.lit('", "extraction": '), basis,
                   F.lit(', "items": ['), row, F.lit("]}"))
    docs = table(spark, sf, "orders").select(F.concat(F.lit("o"), k.cast("string"), F.lit(".json")).alias("file"), doc.alias("doc"))
    keys = table(spark, sf, "customer").select(F.concat(F.lit("Place "), (F.col("c_custkey") % 90).cast("string")).alias("key")).distinct()
    found = Q.document_shape(docs, keys, replace(DocumentRules(), basis_required_from="1998-01-01"))
    what = (F.when(F.contains("detail", F.lit('"2.5"')), "price as text").when(~F.contains("detail", F.lit("description")), "field missing")
            .when(F.contains("detail", F.lit('"  "')), "blank name").otherwise("extra field"))
    return found.withColumn("detail", F.when(F.col("rule") == "malformed-row", what).otherwise(F.col("detail")))


@REGISTRY.add("record_cache", """
SELECT CASE WHEN p_partkey % 4 = 0 THEN 'record-fields' ELSE 'record-dated' END AS rule, 'fail' AS severity, p_partkey || '.json' AS key FROM part WHERE p_partkey % 4 < 3""")
def record_cache(spark, sf):
    k = F.col("p_partkey")
    doc = F.concat(
        F.lit('{"fdcId": '), (k + F.when(k % 4 == 1, 1).otherwise(0)).cast("string"), F.lit(', "dataType": "Foundation", "description": "d", "publicationDate": "1/1/2020", "fetched_at": "'),
        F.when(k % 4 == 2, "").otherwise("2026-01-01"), F.lit('", "nutrients": []'), F.when(k % 4 == 0, "").otherwise(', "portions": []'), F.lit("}"))
    records = table(spark, sf, "part").select(F.concat(k.cast("string"), F.lit(".json")).alias("file"), doc.alias("doc"))
    return Q.record_cache(records).drop("detail")


@REGISTRY.add("tag_check", f"""
WITH {readings.TAG_SQL}, own AS (SELECT kt.id, kt.text_hash, attribute, CASE WHEN kt.id % 29 = 0 AND kt.id % 43 <> 0 AND attribute = 'spicy' THEN 'maybe' ELSE answer END AS answer, words, text FROM kt JOIN tg USING (text_hash) WHERE NOT (kt.id % 31 = 0 AND kt.id % 43 <> 0 AND attribute = 'spicy')),
kept AS (SELECT * FROM own WHERE id % 23 <> 0)
SELECT 'tag-basis' AS rule, id::VARCHAR AS key FROM (SELECT DISTINCT id FROM kept WHERE id % 37 = 0 AND id % 43 <> 0)
UNION ALL SELECT DISTINCT 'tag-text', id::VARCHAR FROM kept WHERE id % 41 = 0 AND id % 43 <> 0
UNION ALL SELECT 'tag-attributes', id::VARCHAR FROM kept GROUP BY id HAVING count(*) <> 2
UNION ALL SELECT 'tag-answer', id || '.' || attribute FROM kept WHERE answer = 'maybe'
UNION ALL SELECT 'item-not-listed', id::VARCHAR FROM own WHERE id % 23 = 0 AND id NOT IN (SELECT id FROM kt WHERE text_hash IN (SELECT text_hash FROM km WHERE m % 6 = 0)) GROUP BY id
UNION ALL SELECT DISTINCT 'tag-without-item', '-' || id FROM kept WHERE id % 43 = 0
UNION ALL SELECT DISTINCT 'item-not-listed', id::VARCHAR FROM kept WHERE id % 43 = 0""")
def tag_check(spark, sf):
    from larderline.plans.readings import tag_table
    items, stored = readings._tag_world(spark, sf)
    tags, untagged = tag_table(items, stored, "b", readings.TWO)
    k = F.col("id")
    moved, spicy = k % 43 == 0, F.col("attribute") == "spicy"
    tags = (tags.filter((k % 23 != 0) & ~((k % 31 == 0) & spicy & ~moved))
            .withColumn("answer", F.when((k % 29 == 0) & spicy & ~moved, "maybe").otherwise(F.col("answer")))
            .withColumn("basis", F.when((k % 37 == 0) & ~moved, "old").otherwise("b"))
            .withColumn("text_hash", F.when((k % 41 == 0) & ~moved, "other").otherwise(F.col("text_hash")))
            .withColumn("id", F.when(moved, -k).otherwise(k)))
    # an item of number zero keeps its id under the sign change
    out = Q.tags(cut(tags.filter("id <> 0")), cut(untagged), items.filter("id <> 0").withColumn("basis", F.lit("b")), readings.TWO)
    return out.select("rule", "key")


@REGISTRY.add("food_map_check", f"""
WITH {foods._MAP_SQL}, f AS (SELECT id, n, is_read, labelled, cand, ikind, NOT labelled AND n > 0 AND is_read AND cand IS NOT NULL AS taken FROM fin),
r AS (SELECT * FROM f WHERE (labelled OR n = 0 OR is_read) AND id % 23 <> 0)
SELECT 'map-kind' AS rule, id::VARCHAR AS key FROM r WHERE id % 29 = 0
UNION ALL SELECT 'map-unmapped', id::VARCHAR FROM r WHERE id % 29 <> 0 AND NOT labelled AND NOT taken AND id % 31 = 0
UNION ALL SELECT 'map-label', id::VARCHAR FROM r WHERE labelled AND id % 38 = 0 AND id % 29 <> 0
UNION ALL SELECT 'map-estimate', id::VARCHAR FROM r WHERE taken AND id % 37 = 0 AND id % 29 <> 0
UNION ALL SELECT 'map-grams', id::VARCHAR FROM r WHERE labelled AND id % 57 = 0
UNION ALL SELECT 'item-not-mapped', id::VARCHAR FROM f WHERE (labelled OR n = 0 OR is_read) AND id % 23 = 0
UNION ALL SELECT 'unread-reason', id::VARCHAR FROM f WHERE NOT labelled AND n > 0 AND NOT is_read AND id % 2 = 0""")
def food_map_check(spark, sf):
    rows, unread = foods._food_map(spark, sf)
    k = F.col("id")
    kind = F.col("kind")
    rows = (rows.filter(k % 23 != 0)
            .withColumn("estimate", F.when((k % 37 == 0), ~F.col("estimate")).otherwise(F.col("estimate")))
            .withColumn("reason", F.when((kind == "unmapped") & (k % 31 == 0), "").otherwise(F.col("reason")))
            .withColumn("grams", F.when((kind == "label") & (k % 57 == 0), 0.0).otherwise(F.col("grams")))
            .withColumn("kind", F.when(k % 29 == 0, "guess").otherwise(kind)))
    unread = unread.withColumn("reason", F.when(k % 2 == 0, "").otherwise(F.col("reason")))
    items = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 2 == 0, "menu").otherwise("product").alias("kind"))
    labels = table(spark, sf, "part").filter((F.col("p_partkey") % 19 == 0) & (F.col("p_partkey") % 38 != 0)).select(F.col("p_partkey").alias("id"))
    return Q.food_map(cut(rows), cut(unread), items, labels).select("rule", "key")


@REGISTRY.add("golden_compare", """
WITH got AS (SELECT o_orderstatus AS c, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1, 2), ex AS (SELECT o_orderstatus AS c, o_orderpriority AS p, count(*) AS n FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 2 = 0) GROUP BY 1, 2)
SELECT 'golden' AS rule, ex.c AS key, ex.p || ' = ' || ex.n AS detail FROM ex WHERE NOT EXISTS (SELECT 1 FROM got WHERE got.c = ex.c AND got.p = ex.p AND got.n = ex.n)""")
def golden_compare(spark, sf):
    o = table(spark, sf, "orders")
    long = lambda df: df.groupBy(F.col("o_orderstatus").alias("case"), F.col("o_orderpriority").alias("path")).agg(F.count(F.lit(1)).cast("string").alias("value"))
    return Q.golden(long(o.filter(~((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 2 == 0)))), long(o)).drop("severity")


@REGISTRY.add("reading_rows", """
SELECT 'reading-basis' AS rule, 'fail' AS severity, event_id::VARCHAR AS key, 'no basis, models or samples' AS detail FROM events WHERE event_type IN ('error', 'signup') OR value < 3""")
def reading_rows(spark, sf):
    e = F.col("event_type")
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("key"), F.when(e != "error", e).alias("basis"), F.when(e == "signup", F.array().cast("array<string>")).otherwise(F.array(e)).alias("models"),
        F.when(F.col("value") >= 3, F.array("value")).alias("samples"))
    return Q.reading_rows(rows)


@REGISTRY.add("stored_words", f"""
WITH {readings.TAG_SQL} SELECT 'reading-words' AS rule, text_hash AS key FROM km WHERE m % 6 <> 0 AND ((m + 0) % 7 = 0 OR (m + 1) % 7 = 0 OR (m + 2) % 7 = 0)""")
def stored_words(spark, sf):
    items, stored = readings._tag_world(spark, sf)
    return Q.stored_words(stored, items).select("rule", "key")


@REGISTRY.add("quality_summary", f"""
WITH d AS (SELECT o_custkey % 5 <> 0 AS has_rows, o_orderdate::DATE + 180 AS due FROM orders), t AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate::DATE END AS due FROM orders)
SELECT 'freshness' AS rule, CASE WHEN DATE '{TODAY}' > due THEN 'fail' ELSE 'warn' END AS severity, count(*) AS n FROM d WHERE has_rows AND DATE '{TODAY}' >= due - 30 GROUP BY ALL
UNION ALL SELECT 'review', CASE WHEN due IS NULL OR DATE '{TODAY}' > due THEN 'fail' ELSE 'warn' END, count(*) FROM t WHERE due IS NULL OR DATE '{TODAY}' >= due - 30 GROUP BY ALL""")
def quality_summary(spark, sf):
    o = table(spark, sf, "orders")
    docs = o.select(F.col("o_orderkey").cast("string").alias("slug"), F.to_date("o_orderdate").cast("string").alias("as_of"), (F.col("o_custkey") % 5).alias("rows"))
    return plan.summary(plan.report([Q.freshness(docs, TODAY), date_window(spark, sf)]))
