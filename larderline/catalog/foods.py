"""Retrieval, food index and nutrients on documents, benchmark texts and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from larderline.catalog.base import FOLD_SQL, Registry, table
from larderline.config import FOOD_RELEASES, SURVEY, FoodRules, NutrientRules
from larderline.functions.text import search_tokens
from larderline.operators import nutrients as N
from larderline.operators import reports as R
from larderline.operators.dedup import numbered_chunks
from larderline.operators.matching import token_frequency
from larderline.operators.ordering import each
from larderline.operators.retrieval import candidate_foods, question_text as ask, retrieve, with_weights
from larderline.plans import readings as plan
from larderline.session import spread

REGISTRY = Registry()
RULES = FoodRules()


def _words_sql(c: str) -> str:
    return f"list_filter(regexp_extract_all(lower({FOLD_SQL.format(c)}), '[a-z]+'), lambda w: length(w) > 2)"


_STEM = ("CASE WHEN length(w) > 4 AND w LIKE '%es' AND w NOT LIKE '%ses' THEN left(w, length(w) - 2) "
         "WHEN length(w) > 3 AND w LIKE '%s' AND w NOT LIKE '%ss' THEN left(w, length(w) - 1) ELSE w END")


def tokens_sql(c: str) -> str:
    """Search tokens of a text, distinct."""
    words = _words_sql(c)
    return (f"list_distinct(list_concat(list_transform({words}, lambda w: {_STEM}), "
            f"list_transform(list_filter({words}, lambda w: length(w) >= 5), lambda w: '~' || left(w, 5))))")


@REGISTRY.add("token_df", f"""
SELECT token, count(*) AS df FROM (SELECT unnest({tokens_sql('text')}) AS token FROM documents) GROUP BY token""")
def token_df(spark, sf):
    return token_frequency(spread(table(spark, sf, "documents").select("text")), search_tokens(F.col("text"), RULES.prefix_length))


def _foods(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("fdcId"), F.when(F.col("lang") == "en", SURVEY).otherwise("SR Legacy").alias("dataType"),
        F.when(F.col("source") == "src3", "Fast Foods").otherwise(F.col("source")).alias("category"),
        F.col("text").alias("description"))


def _asked(spark, sf):
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("id"), F.when(F.col("item_id") % 2 == 0, "Prawn, penne").otherwise("").alias("section"),
        F.col("text").alias("name"), F.lit("").alias("description"))


_ITEM_TOKENS = f"""
itok AS (SELECT item_id AS id, unnest({tokens_sql('text')}) AS token, 1.0::DOUBLE AS w FROM benchmark
  UNION ALL SELECT item_id, unnest({tokens_sql("'Prawn, penne shrimp pasta'")}), 0.25::DOUBLE FROM benchmark WHERE item_id % 2 = 0),
iw AS (SELECT id, token, max(w) * CASE WHEN token LIKE '~%' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS w FROM itok GROUP BY id, token)"""


@REGISTRY.add("item_weights", f"WITH {_ITEM_TOKENS} SELECT id, token, w FROM iw")
def item_weights(spark, sf):
    return each(with_weights(_asked(spark, sf), "tw"), "tw", "x").select("id", "x.token", "x.w")


@REGISTRY.add("retrieve_topk", f"""
WITH {_ITEM_TOKENS},
food AS (SELECT doc_id AS fdcId, CASE WHEN lang = 'en' THEN 'dish' ELSE 'single' END AS pool, {tokens_sql('text')} AS toks FROM documents
  WHERE lang = 'en' OR source <> 'src3'),
post AS (SELECT fdcId, pool, unnest(toks) AS token FROM food),
df AS (SELECT token, ln((SELECT count(*) FROM food) / count(*)) AS idf FROM post GROUP BY token),
sc AS (SELECT id, pool, fdcId, round(list_sum(list(w * idf ORDER BY token)), 9) AS score FROM iw JOIN post USING (token) JOIN df USING (token) GROUP BY id, pool, fdcId),
r AS (SELECT *, row_number() OVER (PARTITION BY id, pool ORDER BY score DESC, fdcId) AS rank FROM sc)
SELECT id, pool, rank, fdcId, round(score, 6) AS score FROM r WHERE rank <= 8""")
def retrieve_topk(spark, sf):
    foods = candidate_foods(_foods(spark, sf))
    return retrieve(_asked(spark, sf), foods).withColumn("score", F.round("score", 6))


def _map_inputs(spark, sf):
    """Parts as items with up to four candidates each."""
    k = F.col("p_partkey")
    candidate = lambda i: F.struct(
        (k * 10 + i).alias("fdcId"), F.when((k + i) % 2 == 0, SURVEY).otherwise("Foundation").alias("dataType"),
        F.when((k + i) % 3 == 0, "Pizza").otherwise("Dried fruits").alias("category"),
        F.concat(F.lit("food "), i.cast("string")).alias("description"),
        F.array(F.struct(F.lit("1 cup").alias("label"), (F.lit(100.0) + i).alias("grams")),
                F.struct(F.lit("1 slice").alias("label"), (F.lit(30.0) + i).alias("grams"))).alias("all_portions"))
    n = k % 5
    return table(spark, sf, "part").select(
        k.alias("id"), F.when(k % 2 == 0, "menu").otherwise("product").alias("kind"),
        F.when(k % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit(" Oz"))).otherwise("1 Each").alias("size"),
        F.concat(F.lit("k"), k.cast("string")).alias("key"),
        F.when(n > 0, F.transform(F.sequence(F.lit(1), n.cast("int")), candidate)).alias("candidates"))


def _map_readings(spark, sf):
    """Three samples per key, from the customer number; keys divisible by eleven are unread."""
    k = F.col("c_custkey")
    choice = lambda n: F.when((k + n) % 13 == 0, "none").otherwise(F.concat(F.lit("c"), ((k % 3) + F.when(k % 7 == n, 1).otherwise(0) + 1).cast("string")))
    portion = lambda n: F.when((k + n) % 4 == 0, "none").otherwise(F.concat(F.lit("p"), (k % 2 + 1).cast("string")))
    sample = lambda n: F.struct(F.when((k + n) % 17 != 0, choice(n)).alias("c"), portion(n).alias("p"),
                                ((k + n) % 17 == 0).alias("refusal"))
    return table(spark, sf, "customer").filter(k % 11 != 0).select(
        F.concat(F.lit("k"), k.cast("string")).alias("key"), F.lit("b").alias("basis"), F.array(*[sample(n) for n in range(3)]).alias("samples"),
        k.alias("ord"))


def _sample_sql(n: int) -> str:
    return (f"{{'c': CASE WHEN (q + {n}) % 17 = 0 THEN 'refused' WHEN (q + {n}) % 13 = 0 THEN 'none' ELSE 'c' || (q % 3 + CASE WHEN q % 7 = {n} THEN 1 ELSE 0 END + 1) END, "
            f"'p': CASE WHEN (q + {n}) % 17 = 0 OR (q + {n}) % 4 = 0 THEN 'none' ELSE 'p' || (q % 2 + 1) END}}")


_MAP_SQL = f"""
it AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'menu' ELSE 'product' END AS ikind, p_partkey % 3 = 0 AS sized, p_size, p_partkey AS q, (p_partkey % 5)::INT AS n FROM part),
rd AS (SELECT *, [{', '.join(_sample_sql(n) for n in range(3))}] AS ss, q < (SELECT count(*) FROM customer) AND q % 11 <> 0 AS is_read FROM it),
vt AS (SELECT *, list_filter(list_transform(list_filter(ss, lambda s: s.c LIKE 'c_'), lambda s: substring(s.c, 2)::INT), lambda k: k <= n) AS ks,
  len(list_filter(ss, lambda s: s.c = 'none')) AS nn FROM rd),
tp AS (SELECT *, list_sort(list_transform(list_distinct(ks), lambda k: {{'m': -len(list_filter(ks, lambda x: x = k)), 'f': list_position(ks, k), 'k': k}}))[1] AS t FROM vt),
rt AS (SELECT *, CASE WHEN -t.m >= 3 THEN t.k END AS cand FROM tp),
pp AS (SELECT *, list_transform(list_filter(ss, lambda s: s.c = 'c' || cand AND s.p <> 'none'), lambda s: substring(s.p, 2)::INT) AS ps FROM rt),
fin AS (SELECT *, CASE WHEN len(list_filter(ps, lambda x: x = ps[1])) >= 2 THEN ps[1] END AS portion, id % 19 = 0 AS labelled FROM pp)"""


@REGISTRY.add("question_text", """
WITH p AS (SELECT p_partkey AS k, p_partkey % 5 AS n, p_name, p_type, p_size, CASE WHEN p_partkey % 4 = 0 THEN p_brand ELSE '' END AS brand FROM part),
c AS (SELECT k, string_agg('c' || i || CASE WHEN (k + i) % 2 = 0 THEN ' [DISH] ' ELSE ' [FOOD] ' END || 'food ' || i || ' | portions: p1 1 cup (' || printf('%g', 100 + i + k / 7.0::DOUBLE) || ' g); p2 1 slice (' ||
  printf('%g', (30 + i) * 100000.0::DOUBLE * (k % 3)) || ' g)', chr(10) ORDER BY i) AS rows FROM p, range(1, 5) r(i) WHERE i <= n GROUP BY k)
SELECT p.k AS id, concat_ws(chr(10), 'Section: ' || p_type, 'Item: ' || p_name, CASE WHEN brand <> '' THEN 'Description: ' || brand END,
  'Package: ' || CASE WHEN k % 3 = 0 THEN p_size || ' Oz' ELSE '1 Each' END, 'Kind: ' || CASE WHEN k % 2 = 0 THEN 'restaurant or cafe menu item' ELSE 'packaged store product' END,
  '', 'Candidates:', coalesce(rows, '')) AS text FROM p LEFT JOIN c USING (k)""")
def question_text(spark, sf):
    k = F.col("p_partkey")
    grams = lambda i: F.array(F.struct(F.lit("1 cup").alias("label"), (100 + i + k / 7).alias("grams")), F.struct(F.lit("1 slice").alias("label"), ((30 + i) * 100000.0 * (k % 3)).alias("grams")))
    own = table(spark, sf, "part").select(k.alias("id"), F.col("p_type").alias("section"), F.col("p_name").alias("name"), F.when(k % 4 == 0, F.col("p_brand")).otherwise("").alias("description"))
    listed = F.transform("candidates", lambda c: c.withField("portions", grams(c["fdcId"] - F.col("id") * 10)))
    inputs = _map_inputs(spark, sf).join(own, "id").withColumn("p_partkey", F.col("id")).withColumn("candidates", listed)
    return inputs.select("id", ask().alias("text"))


@REGISTRY.add("food_map", f"""
WITH {_MAP_SQL}, d AS (SELECT *, NOT labelled AND n > 0 AND is_read AND cand IS NOT NULL AS taken, (id + cand) % 2 = 0 AND (id + cand) % 3 = 0 AS dish FROM fin
  WHERE labelled OR n = 0 OR is_read)
SELECT id, CASE WHEN labelled THEN 'label' WHEN taken THEN CASE WHEN dish THEN 'usda-mixed-dish-estimate' ELSE 'usda-single-food' END ELSE 'unmapped' END AS kind,
  CASE WHEN labelled THEN false WHEN taken THEN dish OR ikind = 'menu' END AS estimate, CASE WHEN taken THEN id * 10 + cand END AS fdcId,
  CASE WHEN labelled THEN NULL WHEN n = 0 THEN 0 WHEN taken THEN 3 WHEN nn = 3 THEN 3 ELSE greatest(coalesce(-t.m, 0), nn) END AS agree,
  CASE WHEN labelled THEN 28.0::DOUBLE WHEN taken AND ikind = 'product' AND sized THEN round_even(p_size * 28.349523125::DOUBLE, 1)::DOUBLE
    WHEN taken AND ikind = 'menu' AND portion = 1 THEN 100.0::DOUBLE + cand WHEN taken AND ikind = 'menu' AND portion = 2 THEN 30.0::DOUBLE + cand END AS grams,
  CASE WHEN labelled THEN 'label serving' WHEN taken AND ikind = 'product' AND sized THEN 'package'
    WHEN taken AND ikind = 'menu' AND portion = 1 THEN 'estimated portion: 1 cup' WHEN taken AND ikind = 'menu' AND portion = 2 THEN 'estimated portion: 1 slice' END AS grams_basis,
  CASE WHEN labelled OR taken THEN NULL WHEN n = 0 THEN 'no candidate shares a word with the item' WHEN nn = 3 THEN 'no candidate is the same food'
    ELSE 'readings do not agree on one record' END AS reason FROM d""")
def food_map(spark, sf):
    return _food_map(spark, sf)[0].select("id", "kind", "estimate", "fdcId", "agree", "grams", "grams_basis", "reason")


def _food_map(spark, sf):
    labels = table(spark, sf, "part").filter(F.col("p_partkey") % 19 == 0).select(F.col("p_partkey").alias("id"), F.lit(28.0).alias("serving_g"))
    return plan.food_map(_map_inputs(spark, sf), _map_readings(spark, sf), "b", labels)


@REGISTRY.add("food_map_unread", f"WITH {_MAP_SQL} SELECT id, 'k' || q AS key FROM fin WHERE NOT labelled AND n > 0 AND NOT is_read")
def food_map_unread(spark, sf):
    return _food_map(spark, sf)[1].select("id", "key")


@REGISTRY.add("map_reasons", f"""
WITH {_MAP_SQL} SELECT CASE WHEN labelled THEN 'label' WHEN n > 0 AND cand IS NOT NULL THEN CASE WHEN (id + cand) % 2 = 0 AND (id + cand) % 3 = 0 THEN 'usda-mixed-dish-estimate' ELSE 'usda-single-food' END ELSE 'unmapped' END AS kind,
 CASE WHEN labelled OR (n > 0 AND cand IS NOT NULL) THEN NULL WHEN n = 0 THEN 'no candidate shares a word with the item' WHEN nn = 3 THEN 'no candidate is the same food' ELSE 'readings do not agree on one record' END AS reason,
 count(*) AS n FROM fin WHERE labelled OR n = 0 OR is_read GROUP BY ALL""")
def map_reasons(spark, sf):
    return R.reason_counts(_food_map(spark, sf)[0])


_RELEASES = tuple(FOOD_RELEASES)
_TYPES = tuple(t for t, _ in FOOD_RELEASES.values())
_API = tuple(t for _, t in FOOD_RELEASES.values())
_pick = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))
_sql_list = lambda values: "[" + ", ".join(f"'{v}'" for v in values) + "]"


@REGISTRY.add("food_portions", f"""
WITH f AS (SELECT p_partkey AS id, p_partkey % 3 AS r FROM part WHERE p_partkey % 10 <> 9),
po AS (SELECT l_partkey AS id, l_linenumber, round_even(l_quantity / 4, 1)::DOUBLE AS g, l_linenumber % 6 AS u FROM lineitem WHERE l_tax > 0.01::DOUBLE),
lab AS (SELECT po.*, r, trim(concat_ws(' ', l_linenumber::VARCHAR, CASE WHEN u < 5 THEN (SELECT r_name FROM region WHERE r_regionkey = u) END,
  CASE WHEN l_linenumber % 2 = 0 THEN 'chopped' END)) AS label FROM po JOIN f USING (id))
SELECT id::VARCHAR AS fdc_id, CASE WHEN r = 2 AND l_linenumber % 3 = 0 THEN 'as served' WHEN l_linenumber % 3 = 0 THEN label || ' as served' ELSE label END AS label, g AS grams FROM lab""")
def food_portions(spark, sf):
    food, portions, units, _ = _bulk(spark, sf)
    return N.food_portions(N.own_foods(food), portions, units).select("fdc_id", "label", "grams")


def _bulk(spark, sf):
    """Parts as foods and order lines as their portions, in the tables of the bulk releases."""
    k = F.col("p_partkey")
    release = _pick(_RELEASES, k % 3)
    food = table(spark, sf, "part").select(
        release.alias("release"), k.cast("string").alias("fdc_id"), F.when(k % 10 == 9, "market").otherwise(_pick(_TYPES, k % 3)).alias("data_type"),
        F.col("p_name").alias("description"), (F.col("p_size") % 27).cast("string").alias("food_category_id"))
    n = F.col("l_linenumber")
    portions = table(spark, sf, "lineitem").select(
        _pick(_RELEASES, F.col("l_partkey") % 3).alias("release"), F.col("l_partkey").cast("string").alias("fdc_id"),
        F.struct("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice").alias("ord"), n.cast("string").alias("amount"),
        (n % 6).cast("string").alias("measure_unit_id"), F.when(n % 2 == 0, " chopped ").otherwise("").alias("modifier"),
        F.when(n % 3 == 0, " as served ").otherwise("").alias("portion_description"),
        F.when(F.col("l_tax") > 0.01, (F.col("l_quantity") / 4).cast("string")).otherwise("").alias("gram_weight"))
    releases = F.explode(F.array(*[F.lit(r) for r in _RELEASES])).alias("release")
    units = table(spark, sf, "region").select(releases, F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name"))
    categories = table(spark, sf, "nation").select(releases, F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("description"))
    return food, portions, units, categories


@REGISTRY.add("food_index", f"""
WITH f AS (SELECT p_partkey AS id, p_partkey % 3 AS r, p_name AS description, p_size % 27 AS cat FROM part WHERE p_partkey % 10 <> 9),
po AS (SELECT l_partkey AS id, l_orderkey, l_linenumber, l_quantity, l_extendedprice,
  round_even(l_quantity / 4, 1)::DOUBLE AS g, l_linenumber % 6 AS u FROM lineitem WHERE l_tax > 0.01::DOUBLE),
lab AS (SELECT po.*, r, trim(regexp_replace(concat_ws(' ', l_linenumber::VARCHAR, CASE WHEN u < 5 THEN (SELECT r_name FROM region WHERE r_regionkey = u) END,
  CASE WHEN l_linenumber % 2 = 0 THEN 'chopped' END), ' +', ' ', 'g')) AS label FROM po JOIN f USING (id)),
agg AS (SELECT id, string_agg((CASE WHEN r = 2 AND l_linenumber % 3 = 0 THEN 'as served' WHEN l_linenumber % 3 = 0 THEN label || ' as served' ELSE label END) || '=' || g, '; '
  ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS portions FROM lab GROUP BY id)
SELECT id AS fdcId, {_sql_list(_API)}[r::INT + 1] AS dataType, description, coalesce((SELECT n_name FROM nation WHERE n_nationkey = cat), '') AS category,
  coalesce(portions, '') AS portions FROM f LEFT JOIN agg USING (id)""")
def food_index(spark, sf):
    text = F.array_join(F.transform("portions", lambda p: F.concat(p["label"], F.lit("="), p["grams"].cast("string"))), "; ")
    return N.food_index(*_bulk(spark, sf)).withColumn("portions", text)


_IDS = (1008, 2047, 1003, 1079, 1093, 2000, 1063, 1004, 1258, 1005, 2048)
_NBR = {1008: "208", 2047: "957", 2048: "958", 1003: "203", 1079: "291", 1093: "307", 2000: "269", 1063: "269.0", 1004: "204", 1258: "606", 1005: "205"}


def _amounts(spark, sf):
    """Order lines as nutrient amounts of the food l_orderkey; the last row of a pair counts."""
    n = F.col("l_linenumber")
    wanted = _pick(_IDS, (n + F.col("l_orderkey")) % 11)
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("fdcId"), wanted.alias("nid"), F.when(F.col("l_quantity") % 5 == 0, "").otherwise(F.col("l_quantity").cast("string")).alias("amount"),
        F.struct("l_linenumber", "l_extendedprice").alias("ord"))


_FIELDS = {f: ids for f, ids in NutrientRules().fields.items()}


def _per_sql() -> str:
    cols = []
    for f, ids in _FIELDS.items():
        cols.append(f"coalesce({', '.join(f'n{i}' for i in ids)}) AS {f}")
        cols.append("CASE " + " ".join(f"WHEN n{i} IS NOT NULL THEN {i}" for i in ids) + f" END AS {f}_id")
    return ", ".join(cols)


NUTRIENT_SQL = f"""
am AS (SELECT l_orderkey AS food, {list(_IDS)}[((l_linenumber + l_orderkey) % 11)::INT + 1] AS nid, CASE WHEN l_quantity % 5 <> 0 THEN l_quantity END AS amount,
  l_linenumber, l_extendedprice FROM lineitem),
la AS (SELECT food, nid, amount FROM am QUALIFY row_number() OVER (PARTITION BY food, nid ORDER BY l_linenumber DESC, l_extendedprice DESC) = 1),
pv AS (SELECT food, {', '.join(f'any_value(amount) FILTER (nid = {i}) AS n{i}' for i in _IDS)} FROM la GROUP BY food),
per AS (SELECT food AS fdcId, {_per_sql()} FROM pv)
"""


def nutrient_table(spark, sf):
    rows = N.nutrient_rows(_amounts(spark, sf), "fdcId", "nid", "amount", "ord")
    return rows.select("fdcId", *[F.col(f"per_100g.{f}").alias(f) for f in _FIELDS], *[F.col(f"nutrient_ids.{f}").alias(f"{f}_id") for f in _FIELDS])


@REGISTRY.add("nutrient_fallback", f"WITH {NUTRIENT_SQL} SELECT * FROM per")
def nutrient_fallback(spark, sf):
    return nutrient_table(spark, sf)


@REGISTRY.add("nutrient_nulls", f"WITH {NUTRIENT_SQL} SELECT {', '.join(f'count(*) FILTER ({f} IS NULL) AS {f}' for f in _FIELDS)} FROM per")
def nutrient_nulls(spark, sf):
    return R.null_counts(nutrient_table(spark, sf), list(_FIELDS))


@REGISTRY.add("nutrient_codes", f"""
WITH nb(release, nid, nbr) AS (VALUES {', '.join(f"('{r}', {i}, {int(float(_NBR[i]))})" for r in _RELEASES for i in _IDS)}),
rk(nid, pos) AS (VALUES {', '.join(f'({i}, {p})' for ids in _FIELDS.values() for p, i in enumerate(ids))}),
tb AS (SELECT release, nbr, arg_min(nid, pos) AS nid FROM nb JOIN rk USING (nid) GROUP BY release, nbr),
a AS (SELECT l_orderkey, l_linenumber, l_partkey, {_sql_list(_RELEASES)}[(l_partkey % 3)::INT + 1] AS release,
  CASE WHEN l_partkey % 2 = 0 THEN {list(_IDS)}[(l_linenumber % 11)::INT + 1] ELSE [208, 203, 291, 307, 269, 204, 606, 205, 957, 300, 9999][(l_linenumber % 11)::INT + 1] END AS code FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN code >= 1000 THEN code ELSE tb.nid END AS nid FROM a LEFT JOIN tb ON tb.release = a.release AND tb.nbr = a.code
WHERE CASE WHEN code >= 1000 THEN code ELSE tb.nid END IN (SELECT nid FROM rk)""")
def nutrient_codes(spark, sf):
    n = F.col("l_linenumber") % 11
    code = F.when(F.col("l_partkey") % 2 == 0, _pick([str(i) for i in _IDS], n)).otherwise(
        _pick(["208", "203", "291.0", "307", "269", "204", "606", "205", "957", "300", "9999"], n))
    amounts = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", _pick(_RELEASES, F.col("l_partkey") % 3).alias("release"), code.alias("nutrient_id"))
    rows = [(r, str(i), nbr) for r in _RELEASES for i, nbr in _NBR.items()]
    nutrient = spark.createDataFrame(rows, "release string, id string, nutrient_nbr string")
    return N.resolve_codes(amounts, nutrient).select("l_orderkey", "l_linenumber", "l_partkey", "nid")


@REGISTRY.add("item_nutrients", f"""
WITH {NUTRIENT_SQL}, m AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey * 7) % (SELECT count(*) FROM orders) END AS fdcId, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 300 + 0.5::DOUBLE END AS grams FROM orders)
SELECT id, {', '.join(f'round({f} * grams / 100, 6) AS {f}' for f in _FIELDS)} FROM m LEFT JOIN per USING (fdcId)""")
def item_nutrients(spark, sf):
    k = F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    total = orders.agg(F.count(F.lit(1))).scalar()
    mapped = orders.select(k.alias("id"), F.when(k % 4 != 0, (k * 7) % total).alias("fdcId"), F.when(k % 5 != 0, k % 300 + F.lit(0.5)).alias("grams"))
    out = N.item_amounts(mapped, N.nutrient_rows(_amounts(spark, sf), "fdcId", "nid", "amount", "ord"))
    return out.select("id", *[F.round(f, 6).alias(f) for f in _FIELDS])


@REGISTRY.add("item_amounts", f"""
WITH {NUTRIENT_SQL}, m AS (SELECT o_orderkey AS id, o_orderkey % 9 = 0 AS labelled, CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey * 7) % (SELECT count(*) FROM orders) END AS fdcId, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 300 + 0.5::DOUBLE END AS grams FROM orders),
wide AS (SELECT m.*, {', '.join(_FIELDS)} FROM m LEFT JOIN per USING (fdcId) WHERE NOT labelled)
SELECT id, 'label' AS basis, 'Nutrient ' || l_linenumber AS name, round(l_quantity::DOUBLE, 6) AS amount FROM m JOIN lineitem ON l_orderkey = id WHERE labelled
UNION ALL {' UNION ALL '.join(f"SELECT id, 'record', '{f}', round({f} * grams / 100, 6) FROM wide" for f in _FIELDS)}""")
def item_amounts(spark, sf):
    """Every ninth order has a label with its lines as nutrients, the others a record."""
    k = F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    total = orders.agg(F.count(F.lit(1))).scalar()
    mapped = orders.select(k.alias("id"), F.when(k % 9 == 0, "label").otherwise("usda-single-food").alias("kind"), F.when(k % 4 != 0, (k * 7) % total).alias("fdcId"),
                           F.when(k % 5 != 0, k % 300 + F.lit(0.5)).alias("grams"))
    line = F.struct(F.concat(F.lit("Nutrient "), F.col("l_linenumber").cast("string")).alias("name"), F.lit("mg").alias("unit"), F.col("l_quantity").alias("amount"))
    labels = (table(spark, sf, "lineitem").join(orders.filter(k % 9 == 0).select(k.alias("l_orderkey")), "l_orderkey")
              .groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(line).alias("nutrients")).withColumn("serving_g", F.lit(28.0)))
    out = N.amounts_of_items(mapped, N.nutrient_rows(_amounts(spark, sf), "fdcId", "nid", "amount", "ord"), labels)
    return out.withColumn("amount", F.round("amount", 6))


@REGISTRY.add("missing_records", """
WITH m AS (SELECT DISTINCT l_partkey AS fdcId FROM lineitem UNION SELECT c_custkey FROM customer),
u AS (SELECT fdcId FROM m WHERE fdcId NOT IN (SELECT s_suppkey FROM supplier))
SELECT fdcId, (row_number() OVER (ORDER BY fdcId) - 1) // 20 AS request FROM u""")
def missing_records(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("fdcId"))
    grocery = table(spark, sf, "customer").select(F.col("c_custkey").alias("fdcId"))
    cached = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("fdcId"))
    return numbered_chunks(N.missing_records(N.mapped_records(lines, grocery), cached), "fdcId", NutrientRules().ids_per_request)


@REGISTRY.add("record_flatten", """
WITH x AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber AS n, l_discount > 0.01::DOUBLE AS has, unnest([l_linenumber + 2, l_linenumber, l_linenumber + 1]) AS i FROM lineitem),
g AS (SELECT l_orderkey, l_partkey, l_suppkey, n, has, count(*) FILTER (i % 5 <> 0 AND (has OR i <> n)) AS nutrients, min(i) FILTER (i % 5 <> 0 AND (has OR i <> n)) AS first_id FROM x GROUP BY ALL)
SELECT l_orderkey, l_partkey, l_suppkey, n AS line, any_value(nutrients) AS nutrients, any_value(first_id) AS first_id,
  CASE WHEN l_orderkey % 2 = 0 THEN 'p' || n ELSE n || '.0 cup chopped p' || n END AS labels FROM g JOIN lineitem USING (l_orderkey, l_partkey, l_suppkey)
WHERE l_linenumber = n AND (l_discount > 0.01::DOUBLE) = has GROUP BY l_orderkey, l_partkey, l_suppkey, n, l_extendedprice, has""")
def record_flatten(spark, sf):
    """Each order line as one service record of three nutrients and two portions, one of them unweighed."""
    n = F.col("l_linenumber")
    has = F.col("l_discount") > 0.01
    nutrient = lambda i: F.struct(
        F.struct(F.when(i % 5 != 0, i).alias("id"), i.cast("string").alias("number"), F.lit("x").alias("name"), F.lit("g").alias("unitName")).alias("nutrient"),
        F.when(has | (i != n), F.lit(0.5)).alias("amount"))
    portion = lambda weight: F.struct(
        n.cast("double").alias("amount"), F.struct(F.lit("cup").alias("name")).alias("measureUnit"), F.lit("chopped").alias("modifier"),
        F.concat(F.lit(" p"), n.cast("string")).alias("portionDescription"), F.lit(weight).alias("gramWeight"))
    records = table(spark, sf, "lineitem").select(
        F.struct("l_orderkey", "l_partkey", "l_suppkey", n.alias("line")).alias("fdcId"), F.when(F.col("l_orderkey") % 2 == 0, SURVEY).otherwise("SR Legacy").alias("dataType"),
        F.lit("d").alias("description"), F.lit("4/1/2019").alias("publicationDate"),
        F.array(nutrient(n + 2), nutrient(n), nutrient(n + 1)).alias("foodNutrients"), F.array(portion(5.0), portion(0.0)).alias("foodPortions"))
    flat = N.flatten_records(records, "2026-01-01")
    return flat.select("fdcId.*", F.size("nutrients").alias("nutrients"), F.get("nutrients", F.lit(0))["id"].alias("first_id"),
                       F.array_join(F.transform("portions", lambda p: p["description"]), "; ").alias("labels"))


@REGISTRY.add("content_digest", """
WITH h AS (SELECT sha256(concat_ws(chr(31), o_orderkey::VARCHAR, o_orderstatus, o_orderpriority)) AS h FROM orders),
l AS (SELECT count(*) AS n, sum(('0x' || substring(h, 1, 15))::BIGINT)::VARCHAR AS a, sum(('0x' || substring(h, 16, 15))::BIGINT)::VARCHAR AS b,
  sum(('0x' || substring(h, 31, 15))::BIGINT)::VARCHAR AS c, sum(('0x' || substring(h, 46, 15))::BIGINT)::VARCHAR AS d FROM h)
SELECT n AS rows, sha256(concat_ws('-', n::VARCHAR, a, b, c, d)) AS digest FROM l""")
def content_digest(spark, sf):
    return N.content_digest(table(spark, sf, "orders"), ["o_orderkey", "o_orderstatus", "o_orderpriority"])
