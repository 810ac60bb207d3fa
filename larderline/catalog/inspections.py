"""Inspections from orders and their lines, in three eras, and the entity match on parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from larderline.catalog.base import FOLD_SQL, Registry, metres_sql, point, point_sql, table
from larderline.config import ERA_CURRENT, ERA_PLACARD, ERA_SCORED, MatchRules
from larderline.operators import inspections as I
from larderline.operators.matching import match
from larderline.plans import inspections as plan
from larderline.session import spread

REGISTRY = Registry()
AS_OF = "2001-03-01"


def eras(spark, sf):
    """Orders before 1997, of 1997 and 1998, and later, in the columns of the three datasets."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_totalprice").alias("p"))
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"), "l_partkey", "l_linenumber", "l_linestatus", "l_shipdate")
    c = F.col("c").cast("string")
    lat, lon = point("c")
    where = {"lat": lat.cast("string"), "lon": lon.cast("string")}
    rows = o.join(lines, "k", "left").withColumns(where).withColumn("ord", F.struct("k", "l_linenumber", "l_partkey"))
    part = F.col("l_partkey").cast("string")
    scored = rows.filter("day < '1997-01-01'").select(
        c.alias("business_id"), F.concat(F.lit("Cafe "), c).alias("business_name"),
        F.concat_ws(" ", (F.col("c") % 50 + 1).cast("string"), F.lit("Main St")).alias("business_address"),
        F.concat(F.lit("94133-"), c).alias("postal"), "lat", "lon", F.col("k").cast("string").alias("inspection_id"),
        F.col("day").alias("inspection_date"),
        F.when(F.col("k") % 5 != 0, F.floor(F.col("p") % 100).cast("string")).otherwise("").alias("inspection_score"),
        F.lit("Routine").alias("inspection_type"),
        F.when(part.isNotNull(), F.concat(F.lit("violation "), part)).alias("violation_description"),
        F.when(F.col("l_linenumber") == 1, "High Risk").otherwise("Low Risk").alias("risk_category"), "ord")
    placards = rows.filter("day >= '1997-01-01' and day < '1999-01-01'").select(
        F.col("k").cast("string").alias("inspection_id"), F.concat(F.lit("CAFE "), c).alias("name"),
        F.concat_ws(" ", (F.col("c") % 50 + 1).cast("string"), F.lit("MAIN ST")).alias("address"),
        F.lit("94109").alias("postal"), F.lit(None).cast("string").alias("lat"), F.lit(None).cast("string").alias("lon"),
        F.col("day").alias("date"),
        F.when(F.col("s") == "F", "pass ").when(F.col("s") == "O", "CONDITIIONAL PASS")
        .otherwise("out-of BUSINESS").alias("facility_status"), F.lit("Routine").alias("inspection_type"),
        F.when(part.isNotNull(), F.when(F.col("l_linestatus") == "O", "Major A").otherwise("Minor B")).alias("violation_observed"),
        part.alias("description"), "ord")
    late = o.filter("day >= '1999-01-01'").withColumns(where)
    typed = F.when(F.col("k") % 2 == 0, "Routine").otherwise("")
    current = late.select(
        c.alias("permit_number"), F.concat(F.lit("Cafe "), c, F.lit(" Inc.")).alias("dba"),
        F.concat_ws(" ", (F.col("c") % 50 + 1).cast("string"), F.lit("Main St")).alias("street_address"), "lat", "lon",
        F.col("day").alias("inspection_date"), typed.alias("inspection_type"),
        F.when(F.col("s") == "F", "PASS").when(F.col("s") == "O", "CONDITONAL").otherwise("CLOSURE").alias("facility_rating_status"),
        F.when(F.col("k") % 3 == 0, "").otherwise(F.concat((F.col("k") % 4).cast("string"), F.lit(".0"))).alias("violation_count"),
        F.when(F.col("k") % 6 == 0, "").otherwise(F.concat(F.lit("114119, 1141"), F.lpad((F.col("k") % 60).cast("string"), 2, "0"),
                                                           F.lit(".3 and 7; 114119"))).alias("violation_codes"),
        F.lit("").alias("suspension_notes"),
        F.struct("k", F.lit(0).alias("l_linenumber"), F.lit(0).cast("bigint").alias("l_partkey")).alias("ord"))
    # every fourth typed row also comes untyped, as its later copy
    copies = current.filter((F.col("ord.k") % 4 == 0)).withColumn("inspection_type", F.lit("")).withColumn(
        "ord", F.col("ord").withField("l_linenumber", F.lit(1)))
    return scored, placards, current.unionByName(copies)


ERA_SQL = f"""
o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, strftime(o_orderdate, '%Y-%m-%d') AS day, o_totalprice AS p FROM orders),
v AS (SELECT l_orderkey AS k, l_partkey, l_linenumber, l_linestatus FROM lineitem),
vc AS (SELECT k, count(*) AS n, count(*) FILTER (l_linenumber = 1) AS high, count(*) FILTER (l_linestatus = 'O') AS major FROM v GROUP BY k),
first_era AS (SELECT '{ERA_SCORED}' AS dataset, c::VARCHAR AS business_id, k::VARCHAR AS inspection_key, day AS date, 'Routine' AS type,
  CASE WHEN k % 5 <> 0 THEN floor(p % 100)::INT END AS score, NULL AS status, coalesce(n, 0) AS violation_count, coalesce(high, 0) AS high_risk,
  NULL AS codes FROM o LEFT JOIN vc USING (k) WHERE day < '1997-01-01'),
second_era AS (SELECT '{ERA_PLACARD}' AS dataset, 'CAFE ' || c || '|' || (c % 50 + 1) || ' MAIN ST' AS business_id, k::VARCHAR AS inspection_key, day AS date,
  'Routine' AS type, NULL::INT AS score, CASE s WHEN 'F' THEN 'Pass' WHEN 'O' THEN 'Conditional Pass' ELSE 'Out-Of Business' END AS status,
  coalesce(n, 0) AS violation_count, coalesce(major, 0) AS high_risk, NULL AS codes
  FROM o LEFT JOIN vc USING (k) WHERE day >= '1997-01-01' AND day < '1999-01-01'),
raw3 AS (SELECT k, c, day, CASE WHEN k % 2 = 0 THEN 'Routine' ELSE '' END AS type, s, 0 AS copy FROM o WHERE day >= '1999-01-01'
  UNION ALL SELECT k, c, day, '', s, 1 FROM o WHERE day >= '1999-01-01' AND k % 4 = 0),
der3 AS (SELECT *, CASE s WHEN 'F' THEN 'Pass' WHEN 'O' THEN 'Conditional Pass' ELSE 'Closure' END AS status,
  CASE WHEN k % 3 <> 0 THEN k % 4 WHEN k % 6 = 0 AND s = 'F' THEN 0 END AS cnt,
  CASE WHEN k % 6 = 0 THEN '' WHEN lpad((k % 60)::VARCHAR, 2, '0') || '.3' = '19.3' THEN '114119,114119.3' WHEN lpad((k % 60)::VARCHAR, 2, '0') < '19' THEN '1141' || lpad((k % 60)::VARCHAR, 2, '0') || '.3,114119'
    ELSE '114119,1141' || lpad((k % 60)::VARCHAR, 2, '0') || '.3' END AS codes FROM raw3),
untwinned AS (SELECT * FROM der3 u WHERE type <> '' OR NOT EXISTS (SELECT 1 FROM der3 t WHERE t.type <> '' AND t.c = u.c AND t.day = u.day
  AND t.status = u.status AND t.cnt IS NOT DISTINCT FROM u.cnt)),
last3 AS (SELECT *, c || '_' || day || '_' || type AS key FROM untwinned QUALIFY row_number() OVER (PARTITION BY c, day, type ORDER BY k DESC, copy DESC) = 1),
third_era AS (SELECT '{ERA_CURRENT}' AS dataset, c::VARCHAR AS business_id, key AS inspection_key, day AS date, nullif(type, '') AS type,
  NULL::INT AS score, status, cnt AS violation_count, NULL AS high_risk, codes FROM last3),
insp AS (SELECT * FROM first_era UNION ALL SELECT * FROM second_era UNION ALL SELECT * FROM third_era)
"""


@REGISTRY.add("inspection_unify", f"WITH {ERA_SQL} SELECT * FROM insp")
def inspection_unify(spark, sf):
    return I.inspections(*eras(spark, sf)).select(
        "dataset", "business_id", "inspection_key", F.col("date").cast("string").alias("date"), "type", "score", "status",
        "violation_count", "high_risk", F.array_join("violation_codes", ",").alias("codes"))


@REGISTRY.add("inspection_businesses", f"""
WITH {ERA_SQL}, lo AS (SELECT DISTINCT c FROM o WHERE day < '1997-01-01'), mid AS (SELECT DISTINCT c FROM o WHERE day >= '1997-01-01' AND day < '1999-01-01'),
hi AS (SELECT DISTINCT c FROM untwinned)
SELECT '{ERA_SCORED}' AS dataset, c::VARCHAR AS business_id, 'Cafe ' || c AS name, (c % 50 + 1) || ' Main St' AS address, '94133' AS postal, true AS located FROM lo
UNION ALL SELECT '{ERA_PLACARD}', 'CAFE ' || c || '|' || (c % 50 + 1) || ' MAIN ST', 'CAFE ' || c, (c % 50 + 1) || ' MAIN ST', '94109', false FROM mid
UNION ALL SELECT '{ERA_CURRENT}', c::VARCHAR, 'Cafe ' || c || ' Inc.', (c % 50 + 1) || ' Main St', '', true FROM hi""")
def inspection_businesses(spark, sf):
    return I.businesses(*eras(spark, sf)).select("dataset", "business_id", "name", "address", "postal",
                                                 F.col("lat").isNotNull().alias("located"))


@REGISTRY.add("inspection_violations", f"""
WITH {ERA_SQL}
SELECT '{ERA_SCORED}' AS dataset, c::VARCHAR AS business_id, k::VARCHAR AS inspection_key, 'violation ' || l_partkey AS violation
  FROM o JOIN v USING (k) WHERE day < '1997-01-01'
UNION ALL SELECT '{ERA_PLACARD}', 'CAFE ' || c || '|' || (c % 50 + 1) || ' MAIN ST', k::VARCHAR,
  CASE WHEN l_linestatus = 'O' THEN 'Major A' ELSE 'Minor B' END || ': ' || l_partkey FROM o JOIN v USING (k) WHERE day >= '1997-01-01' AND day < '1999-01-01'
UNION ALL SELECT '{ERA_CURRENT}', c::VARCHAR, key, '114119, 1141' || lpad((k % 60)::VARCHAR, 2, '0') || '.3 and 7; 114119' FROM last3 WHERE k % 6 <> 0""")
def inspection_violations(spark, sf):
    return I.violations(*eras(spark, sf)).drop("ord")


def placed_inspections(spark, sf):
    """Inspections by place: the customer number inside each business id."""
    return I.inspections(*eras(spark, sf)).withColumn("place", F.regexp_extract("business_id", r"(\d+)", 1).cast("bigint"))


SUMMARY_SQL = f"""
placed AS (SELECT *, regexp_extract(business_id, '([0-9]+)', 1)::BIGINT AS place FROM insp WHERE date <= '{AS_OF}'),
last_day AS (SELECT place, max(date) AS d FROM placed GROUP BY place),
last_score AS (SELECT place, max(date) AS d FROM placed WHERE score IS NOT NULL GROUP BY place),
last_stat AS (SELECT place, max(date) AS d FROM placed WHERE status IS NOT NULL GROUP BY place),
l AS (SELECT p.place, any_value(p.date) AS last_inspection_date, count(*) AS last_day_inspections,
  arg_max(struct_pack(t := type, ds := dataset, n := violation_count), struct_pack(v := coalesce(violation_count, 0), k := inspection_key)) AS x
  FROM placed p JOIN last_day q ON p.place = q.place AND p.date = q.d GROUP BY p.place),
s AS (SELECT p.place, min(score) AS last_score, any_value(p.date) AS last_score_date FROM placed p JOIN last_score q ON p.place = q.place AND p.date = q.d
  WHERE score IS NOT NULL GROUP BY p.place),
w AS (SELECT place, min(struct_pack(s := score, d := date)) AS x FROM placed WHERE score IS NOT NULL GROUP BY place),
t AS (SELECT p.place, any_value(p.date) AS last_status_date, arg_min(status, CASE status WHEN 'Closure' THEN 0 WHEN 'Conditional Pass' THEN 1 WHEN 'Pass' THEN 2 ELSE 3 END) AS last_status
  FROM placed p JOIN last_stat q ON p.place = q.place AND p.date = q.d WHERE status IS NOT NULL GROUP BY p.place),
a AS (SELECT place, count(*) AS inspections_total, min(date) AS first_inspection_date, coalesce(sum(high_risk), 0)::BIGINT AS high_risk,
  CASE WHEN count(status) > 0 THEN count(*) FILTER (status = 'Closure') END AS closures,
  CASE WHEN count(status) > 0 THEN count(*) FILTER (status = 'Conditional Pass') END AS conditional,
  string_agg(DISTINCT dataset, ',' ORDER BY dataset) AS eras FROM placed GROUP BY place),
summary AS (SELECT a.*, last_inspection_date, last_day_inspections, l.x.t AS last_type, l.x.ds AS last_dataset, l.x.n AS violation_count_last,
  last_score, last_score_date, w.x.s AS worst_score, w.x.d AS worst_score_date, last_status, last_status_date
  FROM a JOIN l USING (place) LEFT JOIN s USING (place) LEFT JOIN w USING (place) LEFT JOIN t USING (place))
"""


@REGISTRY.add("inspection_summary", f"WITH {ERA_SQL}, {SUMMARY_SQL} SELECT * FROM summary")
def inspection_summary(spark, sf):
    out = I.summarize(placed_inspections(spark, sf), "place", AS_OF)
    day = lambda c: F.col(c).cast("string").alias(c)
    return out.select(
        "place", "inspections_total", day("first_inspection_date"), F.col("high_risk_count_all_time").alias("high_risk"),
        F.col("closures_all_time").alias("closures"), F.col("conditional_pass_all_time").alias("conditional"),
        F.array_join("eras", ",").alias("eras"), day("last_inspection_date"), "last_day_inspections",
        F.col("last_inspection_type").alias("last_type"), F.col("last_inspection_dataset").alias("last_dataset"),
        "violation_count_last", "last_score", day("last_score_date"), F.col("worst_score_all_time").alias("worst_score"),
        day("worst_score_date"), "last_status", day("last_status_date"))


@REGISTRY.add("last_day_violations", f"""
WITH {ERA_SQL}, {SUMMARY_SQL},
texts AS (SELECT '{ERA_SCORED}' AS dataset, k::VARCHAR AS key, 'violation ' || l_partkey AS violation FROM o JOIN v USING (k) WHERE day < '1997-01-01'
  UNION ALL SELECT '{ERA_PLACARD}', k::VARCHAR, CASE WHEN l_linestatus = 'O' THEN 'Major A' ELSE 'Minor B' END || ': ' || l_partkey FROM o JOIN v USING (k) WHERE day >= '1997-01-01' AND day < '1999-01-01'
  UNION ALL SELECT '{ERA_CURRENT}', key, '114119, 1141' || lpad((k % 60)::VARCHAR, 2, '0') || '.3 and 7; 114119' FROM last3 WHERE k % 6 <> 0)
SELECT p.place, p.dataset, p.inspection_key, violation FROM placed p JOIN last_day q ON p.place = q.place AND p.date = q.d
JOIN texts ON texts.dataset = p.dataset AND texts.key = p.inspection_key""")
def last_day_violations(spark, sf):
    rows = placed_inspections(spark, sf)
    summary = I.summarize(rows, "place", AS_OF)
    texts = I.violations(*eras(spark, sf))
    return I.last_day_violations(rows, summary, texts, "place").drop("ord")


def match_sides(spark, sf):
    """Parts as places, and the same parts with changed names, addresses and points as registrations."""
    k = F.col("p_partkey")
    lat, lon = point("p_partkey", 100)
    parts = spread(table(spark, sf, "part"))
    street = F.element_at(F.array(*[F.lit(s) for s in ("Main St", "North Oak Ave", "The Bay", "Elm")]), ((k % 4) + 1).cast("int"))
    addr = F.when(k % 3 == 0, "").otherwise(F.concat_ws(" ", (k % 40 + 1).cast("string"), street))
    first = F.split("p_name", " ")[0]
    second = F.split("p_name", " ")[1]
    serial = (k % 700).cast("string")
    place_name = (F.when(k % 6 == 0, "The Cafe").when(k % 6 == 1, F.concat(F.col("p_name"), F.lit(" North Beach")))
                  .when(k % 6 == 2, F.concat(F.lit("number"), serial, F.lit(" "), first)).otherwise(F.col("p_name")))
    places = parts.select(k.alias("key"), place_name.alias("name"), addr.alias("addr"),
                          F.when(k % 10 != 0, lat).alias("lat"), F.when(k % 10 != 0, lon).alias("lon"))
    name = (F.when(k % 7 == 0, F.upper("p_name")).when(k % 7 == 1, F.concat(second, F.lit(" & "), first, F.lit(" Co.")))
            .when(k % 7 == 2, F.concat(first, second)).when(k % 7 == 3, F.concat(F.col("p_name"), F.lit(" Restaurant of Pier")))
            .when(k % 7 == 4, F.concat(F.lit("Number"), serial)).when(k % 7 == 5, F.concat(first, F.lit(" "), second, F.lit("s")))
            .otherwise(F.concat(F.substring("p_name", 1, 6), F.lit("x"), F.substring(F.col("p_name"), F.lit(8), F.lit(30)))))
    b_street = F.when(k % 9 == 0, F.lit("Oak Ave")).otherwise(street)
    address = F.when(k % 5 == 0, "").otherwise(F.concat_ws(" ", (k % 40 + 1).cast("string"), b_street))
    zips = F.when(k % 4 == 0, "94133").when(k % 4 == 1, "94999").when(k % 4 == 2, "").otherwise("94108-22")
    registrations = parts.select(
        F.when(k % 2 == 0, ERA_SCORED).otherwise(ERA_PLACARD).alias("dataset"), F.lpad(k.cast("string"), 8, "0").alias("business_id"),
        name.alias("name"), address.alias("address"), F.substring(zips, 1, 5).alias("postal"),
        F.when(k % 8 != 0, lat + F.lit(0.0004)).alias("lat"), F.when(k % 8 != 0, lon).alias("lon"))
    return places, registrations


_M = MatchRules()
_words = lambda ws: ", ".join(f"'{w}'" for w in ws)
_CLEAN = r"trim(regexp_replace(replace(regexp_replace(lower(" + FOLD_SQL.replace("{0}", "coalesce({0}, '')") + r"), '[.'']', '', 'g'), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"
_TOKENS = (f"list_transform(list_filter(string_split({_CLEAN}, ' '), lambda w: w NOT IN ('', {_words(_M.stop_words)})), "
           "lambda w: CASE WHEN length(w) > 3 AND w LIKE '%s' AND w NOT LIKE '%ss' THEN left(w, length(w) - 1) ELSE w END)")
_STREET = r"""CASE WHEN regexp_matches(lower({0}), '^\s*[0-9]+\s+[a-z0-9]+') THEN regexp_extract(lower({0}), '^\s*([0-9]+)', 1) || '|' ||
  CASE WHEN regexp_extract(lower({0}), '^\s*[0-9]+\s+([a-z0-9]+)', 1) IN ('n', 's', 'e', 'w', 'north', 'south', 'east', 'west', 'the', 'a', 'b')
    AND regexp_matches(lower({0}), '^\s*[0-9]+\s+[a-z]+\s+[a-z0-9]+') THEN regexp_extract(lower({0}), '^\s*[0-9]+\s+[a-z]+\s+([a-z0-9]+)', 1)
  ELSE regexp_extract(lower({0}), '^\s*[0-9]+\s+([a-z0-9]+)', 1) END END"""
_PLACE = f"[{_words(_M.place_words)}]"

def _longest(x: str, y: str) -> str:
    """(k, -i) of the longest common block of two texts that starts first."""
    return (f"list_max(list_filter(flatten(list_transform(range(1, len({x}) + 1), lambda i: list_transform(range(1, len({x}) - i + 2), lambda k: "
            f"CASE WHEN contains({y}, substring({x}, i, k)) THEN {{'k': k, 'i': -i}} END))), lambda z: z IS NOT NULL))")


PARTS_SQL = f"""
pt AS (SELECT p_partkey AS k, p_name, string_split(p_name, ' ')[1] AS f, string_split(p_name, ' ')[2] AS s2, {point_sql('p_partkey', 100)},
  ['Main St', 'North Oak Ave', 'The Bay', 'Elm'][(p_partkey % 4)::INT + 1] AS street FROM part),
pl AS (SELECT k AS key, CASE k % 6 WHEN 0 THEN 'The Cafe' WHEN 1 THEN p_name || ' North Beach' WHEN 2 THEN 'number' || (k % 700) || ' ' || f ELSE p_name END AS name,
  CASE WHEN k % 3 = 0 THEN '' ELSE (k % 40 + 1) || ' ' || street END AS addr, CASE WHEN k % 10 <> 0 THEN lat END AS plat, CASE WHEN k % 10 <> 0 THEN lon END AS plon FROM pt),
bz AS (SELECT CASE WHEN k % 2 = 0 THEN '{ERA_SCORED}' ELSE '{ERA_PLACARD}' END AS dataset, lpad(k::VARCHAR, 8, '0') AS business_id,
  CASE k % 7 WHEN 0 THEN upper(p_name) WHEN 1 THEN s2 || ' & ' || f || ' Co.' WHEN 2 THEN f || s2 WHEN 3 THEN p_name || ' Restaurant of Pier'
    WHEN 4 THEN 'Number' || (k % 700) WHEN 5 THEN f || ' ' || s2 || 's' ELSE substring(p_name, 1, 6) || 'x' || substring(p_name, 8, 30) END AS name,
  CASE WHEN k % 5 = 0 THEN '' ELSE (k % 40 + 1) || ' ' || CASE WHEN k % 9 = 0 THEN 'Oak Ave' ELSE street END END AS address,
  CASE k % 4 WHEN 0 THEN '94133' WHEN 1 THEN '94999' WHEN 2 THEN '' ELSE '94108' END AS postal,
  CASE WHEN k % 8 <> 0 THEN lat + 0.0004::DOUBLE END AS blat, CASE WHEN k % 8 <> 0 THEN lon END AS blon FROM pt)"""

#: The match of places ``pl`` (key, name, addr, plat, plon) to registrations ``bz``.
RULES_SQL = f"""
p1 AS (SELECT *, {_TOKENS.format('name')} AS tk, {_STREET.format('addr')} AS pstreet FROM pl),
p2 AS (SELECT *, list_sort(list_distinct(tk)) AS pset, array_to_string(tk, '') AS pj FROM p1 WHERE len(tk) > 0),
b1 AS (SELECT *, {_TOKENS.format('name')} AS tk, {_STREET.format('address')} AS bstreet FROM bz),
b2 AS (SELECT *, list_sort(list_distinct(tk)) AS bset, array_to_string(tk, '') AS bj FROM b1),
dft AS (SELECT t, count(*) AS df FROM (SELECT unnest(bset) AS t FROM b2) GROUP BY t),
pb AS (SELECT key, min(df) AS pbest FROM (SELECT key, unnest(pset) AS t FROM p2) JOIN dft USING (t) WHERE NOT list_contains({_PLACE}, t) GROUP BY key),
bb AS (SELECT dataset, business_id, min(df) AS bbest FROM (SELECT dataset, business_id, unnest(bset) AS t FROM b2) JOIN dft USING (t) WHERE NOT list_contains({_PLACE}, t) GROUP BY ALL),
p3 AS (SELECT p2.*, pbest FROM p2 LEFT JOIN pb USING (key)), b3 AS (SELECT b2.*, bbest FROM b2 LEFT JOIN bb USING (dataset, business_id)),
cand AS (SELECT *, CASE WHEN plat IS NOT NULL AND blat IS NOT NULL THEN {metres_sql('plat', 'plon', 'blat', 'blon')} END AS d,
  CASE WHEN pstreet = bstreet THEN 'match' WHEN pstreet IS NOT NULL AND bstreet IS NOT NULL THEN 'conflict' END AS addr_rel,
  CASE WHEN pset = bset THEN 'exact' WHEN pj = bj THEN 'compact' WHEN list_has_all(bset, pset) OR list_has_all(pset, bset) THEN 'subset'
    WHEN len(list_filter(list_intersect(pset, bset), lambda w: NOT list_contains({_PLACE}, w))) >= 2 THEN 'overlap' END AS kind
  FROM p3, b3 WHERE list_has_any(list_append(pset, pj), list_append(bset, bj)) OR coalesce(pstreet = bstreet, false)),
geo AS (SELECT *, CASE WHEN d IS NOT NULL THEN CASE WHEN d <= 120 THEN 'same' WHEN d <= 400 THEN 'near' WHEN d > 1000 THEN 'conflict' ELSE 'far' END
  WHEN postal = '' THEN NULL WHEN postal IN ({_words(_M.area_zips)}) THEN 'zip' ELSE 'conflict' END AS geo FROM cand),
opn AS (SELECT DISTINCT pj AS a, bj AS b FROM geo WHERE kind IS NULL AND (addr_rel = 'match' OR geo = 'same') AND 2.0::DOUBLE * least(len(pj), len(bj)) / greatest(len(pj) + len(bj), 1) >= {_M.fuzzy_ratio}),
blk(a, b, x, y, m) AS (SELECT a, b, a, b, {_longest('a', 'b')} FROM opn
  UNION ALL SELECT a, b, nx, ny, {_longest('nx', 'ny')} FROM (SELECT a, b, unnest([substring(x, 1, i - 1), substring(x, i + k, 10000)]) AS nx, unnest([substring(y, 1, j - 1), substring(y, j + k, 10000)]) AS ny
    FROM (SELECT *, m.k AS k, -m.i AS i, instr(y, substring(x, -m.i, m.k)) AS j FROM blk WHERE m IS NOT NULL)) WHERE nx <> '' AND ny <> ''),
rat AS (SELECT a, b, 2.0::DOUBLE * coalesce(sum(m.k), 0) / (len(a) + len(b)) AS ratio FROM blk GROUP BY a, b),
kin AS (SELECT geo.* REPLACE (CASE WHEN kind IS NULL AND (addr_rel = 'match' OR geo = 'same') AND ratio >= {_M.fuzzy_ratio} THEN 'fuzzy' ELSE kind END AS kind), ratio FROM geo LEFT JOIN rat ON a = pj AND b = bj),
dec AS (SELECT *, CASE WHEN addr_rel = 'match' AND kind IS NOT NULL THEN 'name+address'
  WHEN addr_rel = 'conflict' THEN CASE WHEN (kind IN ('exact', 'compact') OR kind = 'fuzzy' AND ratio >= {_M.fuzzy_strong}) AND geo = 'same' THEN 'name-only' END
  WHEN coalesce(geo IN ('conflict', 'far'), false) THEN NULL
  WHEN kind IN ('exact', 'compact') OR kind = 'fuzzy' AND ratio >= {_M.fuzzy_strong} AND geo = 'same' THEN 'name-only'
  WHEN kind = 'subset' AND ((geo = 'same' AND (CASE WHEN list_has_all(bset, pset) THEN pbest ELSE bbest END <= 20
      OR len(list_filter(CASE WHEN list_has_all(bset, pset) THEN pset ELSE bset END, lambda w: NOT list_contains({_PLACE}, w))) >= 2))
    OR (geo = 'zip' AND CASE WHEN list_has_all(bset, pset) THEN pbest ELSE bbest END <= 3)) THEN 'name-only' END AS conf FROM kin),
acc AS (SELECT * FROM dec WHERE conf IS NOT NULL),
pool1 AS (SELECT *, max(conf = 'name+address') OVER (PARTITION BY key) AS has_a, max(kind IN ('exact', 'compact')) OVER (PARTITION BY key) AS has_e FROM acc),
by_addr AS (SELECT key, dataset, business_id, kind, conf FROM pool1 WHERE has_a AND conf = 'name+address'),
by_name AS (SELECT key, dataset, business_id, kind, conf, d, bj, bstreet, address, false AS sib FROM pool1 WHERE NOT has_a AND (NOT has_e OR kind IN ('exact', 'compact'))),
ids AS (SELECT DISTINCT key, bj, bstreet FROM by_name),
sibs AS (SELECT c.key, c.dataset, c.business_id, 'sibling' AS kind, 'name-only' AS conf, d, c.bj, c.bstreet, address, true AS sib
  FROM cand c JOIN ids i ON c.key = i.key AND c.bj = i.bj AND c.bstreet IS NOT DISTINCT FROM i.bstreet
  WHERE NOT EXISTS (SELECT 1 FROM by_name n WHERE n.key = c.key AND n.dataset = c.dataset AND n.business_id = c.business_id)),
grp AS (SELECT *, coalesce(bstreet, upper(trim(address))) AS g FROM (SELECT * FROM by_name UNION ALL SELECT * FROM sibs)),
per AS (SELECT key, g, coalesce(min(d), 'inf'::DOUBLE) AS gd, min(struct_pack(s := sib, ds := dataset, b := business_id)) AS fst FROM grp GROUP BY key, g),
best AS (SELECT key, count(*) AS ng, arg_min(g, struct_pack(a := gd, b := fst)) AS bg, min(gd) AS bd FROM per GROUP BY key),
chosen AS (SELECT grp.* FROM grp JOIN best USING (key) WHERE ng = 1 OR bd = 'inf'::DOUBLE OR g = bg),
matched AS (SELECT * FROM by_addr UNION ALL SELECT key, dataset, business_id, kind, conf FROM chosen)
"""

MATCH_SQL = f"{PARTS_SQL}, {RULES_SQL}"


@REGISTRY.add("entity_match_names", f"WITH RECURSIVE {MATCH_SQL} SELECT key, dataset, business_id, kind, conf AS confidence FROM matched")
def entity_match_names(spark, sf):
    """The accepted registrations of every place; the SQL finds matching blocks of names by recursion."""
    return match(*match_sides(spark, sf)).matches.drop("addr_note")


@REGISTRY.add("entity_match_other_addresses", f"""
WITH RECURSIVE {MATCH_SQL} SELECT DISTINCT key, upper(trim(address)) AS other_address FROM grp JOIN best USING (key) WHERE NOT (ng = 1 OR bd = 'inf'::DOUBLE OR g = bg)""")
def entity_match_other_addresses(spark, sf):
    return match(*match_sides(spark, sf)).other_addresses


@REGISTRY.add("entity_match", f"""
WITH RECURSIVE {MATCH_SQL},
noted AS (SELECT key, kind, conf, addr_rel = 'conflict' AS differs FROM matched JOIN (SELECT key, dataset, business_id, addr_rel FROM acc) USING (key, dataset, business_id) WHERE kind <> 'sibling'
  UNION ALL SELECT key, kind, conf, false FROM matched WHERE kind = 'sibling'),
s AS (SELECT key, max(conf) AS conf, array_to_string(list_sort(list_distinct(list(kind))), ',') AS methods, count(*) AS n, bool_or(coalesce(differs, false)) AS differs FROM noted GROUP BY key)
SELECT pt.k AS key, coalesce(conf, 'none') AS confidence, methods, coalesce(n, 0) AS registrations, coalesce(differs, false) AS number_differs, coalesce(ng > 1 AND bd = 'inf'::DOUBLE, false) AS multiple_addresses
FROM pt LEFT JOIN s ON pt.k = s.key LEFT JOIN best ON pt.k = best.key""")
def entity_match(spark, sf):
    """The whole match, spelling similarity included: confidence and methods per place."""
    return match(*match_sides(spark, sf)).places.withColumn("methods", F.array_join("methods", ","))


def _match_layer(spark, sf):
    """The match as a layer, with three categories of places."""
    return match(*match_sides(spark, sf)).places.withColumnRenamed("confidence", "match_confidence").withColumn("category", F.concat(F.lit("c"), (F.col("key") % 3).cast("string")))


_LAYER_SQL = f"""{MATCH_SQL}, kinds AS (SELECT key, max(conf) AS conf, list_distinct(list(kind)) AS kinds FROM matched GROUP BY key),
lay AS (SELECT pt.k AS key, 'c' || pt.k % 3 AS category, coalesce(conf, 'none') AS match_confidence, kinds FROM pt LEFT JOIN kinds ON pt.k = kinds.key)"""


@REGISTRY.add("entity_match_report", f"""
WITH RECURSIVE {_LAYER_SQL} SELECT category, match_confidence, count(*) AS places, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM lay)) AS percent FROM lay GROUP BY ALL""")
def entity_match_report(spark, sf):
    """Places by confidence and category, of the match itself."""
    return plan.confidence_report(_match_layer(spark, sf), "category")


@REGISTRY.add("entity_match_methods", f"WITH RECURSIVE {_LAYER_SQL} SELECT match_confidence, method, count(*) AS places FROM (SELECT match_confidence, unnest(kinds) AS method FROM lay) GROUP BY ALL")
def entity_match_methods(spark, sf):
    return plan.method_report(_match_layer(spark, sf))


@REGISTRY.add("inspection_range", f"WITH {ERA_SQL} SELECT min(date) || '..' || max(date) AS span FROM insp WHERE date <= '{AS_OF}'")
def inspection_range(spark, sf):
    return I.date_span(I.inspections(*eras(spark, sf)), AS_OF)


@REGISTRY.add("entity_match_rejected", f"""
WITH RECURSIVE {MATCH_SQL.replace(" AND (addr_rel = 'match' OR geo = 'same')", "")},
rej AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY dataset, business_id) AS place_no FROM dec WHERE conf IS NULL AND kind IS NOT NULL)
SELECT key, dataset, business_id, kind, CASE WHEN addr_rel = 'conflict' THEN 'addr-conflict' ELSE geo END AS reason FROM rej WHERE place_no <= {_M.rejected_kept}""")
def entity_match_rejected(spark, sf):
    """The first rejected registrations of every place; the SQL rates the spelling of all pairs that share a word or the address."""
    return match(*match_sides(spark, sf)).rejected


def _report_layer(spark, sf):
    """Summaries with a confidence and methods derived from the place number."""
    out = I.summarize(placed_inspections(spark, sf), "place", AS_OF)
    p = F.col("place")
    return out.select(
        "*", F.when(p % 5 == 0, "none").when(p % 2 == 0, "name-only").otherwise("name+address").alias("match_confidence"),
        F.when(p % 5 != 0, F.when(p % 3 == 0, F.array(F.lit("exact"), F.lit("subset"))).otherwise(F.array(F.lit("exact")))).alias("methods"))


@REGISTRY.add("match_report", f"""
WITH {ERA_SQL}, {SUMMARY_SQL},
c AS (SELECT CASE WHEN place % 5 = 0 THEN 'none' WHEN place % 2 = 0 THEN 'name-only' ELSE 'name+address' END AS match_confidence FROM summary)
SELECT match_confidence, count(*) AS places, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM c)) AS percent FROM c GROUP BY 1""")
def match_report(spark, sf):
    return plan.confidence_report(_report_layer(spark, sf))


@REGISTRY.add("match_methods", f"""
WITH {ERA_SQL}, {SUMMARY_SQL},
c AS (SELECT CASE WHEN place % 2 = 0 THEN 'name-only' ELSE 'name+address' END AS match_confidence,
  unnest(CASE WHEN place % 3 = 0 THEN ['exact', 'subset'] ELSE ['exact'] END) AS method FROM summary WHERE place % 5 <> 0)
SELECT match_confidence, method, count(*) AS places FROM c GROUP BY 1, 2""")
def match_methods(spark, sf):
    return plan.method_report(_report_layer(spark, sf))


@REGISTRY.add("match_eras", f"""
WITH {ERA_SQL}, {SUMMARY_SQL}, e AS (SELECT unnest(string_split(eras, ',')) AS era, last_inspection_date, last_score FROM summary)
SELECT era, count(*) AS places, count(*) FILTER (last_inspection_date >= '2000-01-01') AS recent, count(last_score) AS scored FROM e GROUP BY era""")
def match_eras(spark, sf):
    return plan.era_report(_report_layer(spark, sf), "2000-01-01")


@REGISTRY.add("inspection_layer", f"""
WITH RECURSIVE {ERA_SQL},
guests AS (SELECT c_custkey, {point_sql('c_custkey')} FROM customer),
pl AS (SELECT c_custkey AS key, 'Café ' || c_custkey AS name, CASE WHEN c_custkey % 4 <> 0 THEN (c_custkey % 50 + 1) || ' Main Street' ELSE '' END AS addr, lat AS plat, lon AS plon FROM guests),
seen AS (SELECT DISTINCT c, day < '1997-01-01' AS lo, day >= '1997-01-01' AND day < '1999-01-01' AS mid FROM o),
spots AS (SELECT c, lo, mid, {point_sql('c')} FROM seen),
bz AS (SELECT CASE WHEN lo THEN '{ERA_SCORED}' WHEN mid THEN '{ERA_PLACARD}' ELSE '{ERA_CURRENT}' END AS dataset,
  CASE WHEN mid THEN 'CAFE ' || c || '|' || (c % 50 + 1) || ' MAIN ST' ELSE c::VARCHAR END AS business_id,
  CASE WHEN lo THEN 'Cafe ' || c WHEN mid THEN 'CAFE ' || c ELSE 'Cafe ' || c || ' Inc.' END AS name, (c % 50 + 1) || CASE WHEN mid THEN ' MAIN ST' ELSE ' Main St' END AS address,
  CASE WHEN lo THEN '94133' WHEN mid THEN '94109' ELSE '' END AS postal, CASE WHEN NOT mid THEN lat END AS blat, CASE WHEN NOT mid THEN lon END AS blon FROM spots),
{RULES_SQL}, {SUMMARY_SQL.replace("SELECT *, regexp_extract(business_id, '([0-9]+)', 1)::BIGINT AS place FROM insp WHERE", "SELECT insp.*, key AS place FROM insp JOIN matched USING (dataset, business_id) WHERE")},
counted AS (SELECT key, max(conf) AS conf, count(*) AS n FROM matched GROUP BY key)
SELECT pl.key, coalesce(conf, 'none') AS match_confidence, coalesce(n, 0) AS registrations, inspections_total, last_score, last_status
FROM pl LEFT JOIN counted ON pl.key = counted.key LEFT JOIN summary ON summary.place = pl.key""")
def inspection_layer(spark, sf):
    """Customers as places matched to the registrations of the three eras, with their summaries."""
    k = F.col("c_custkey")
    lat, lon = point("c_custkey")
    places = table(spark, sf, "customer").select(
        k.alias("key"), F.concat(F.lit("Café "), k.cast("string")).alias("name"),
        F.when(k % 4 != 0, F.concat_ws(" ", (k % 50 + 1).cast("string"), F.lit("Main Street"))).alias("addr"),
        lat.alias("lat"), lon.alias("lon"))
    layer, _ = plan.inspection_layer(places, *eras(spark, sf), AS_OF)
    return layer.select("key", "match_confidence", "registrations", "inspections_total", "last_score", "last_status")
