"""Readings, votes, pending work and comparisons on events, documents, labels and conversations."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from larderline.catalog.base import Registry, table
from larderline.config import VoteRules
from larderline.functions.text import text_hash
from larderline.operators import reports as R
from larderline.operators import votes as V
from larderline.operators.ordering import latest_rows
from larderline.plans import readings as plan
from larderline.sources.writers import upsert_readings

REGISTRY = Registry()
CODES = {"click": "y", "view": "y", "purchase": "n", "error": "u", "signup": "n"}


def vote_samples(spark, sf):
    """Every event of a user as a vote; the item's text has the words of its first and last event."""
    events = table(spark, sf, "events").select("user_id", F.struct("ts", "event_id").alias("ord"), "event_type", F.get_json_object("props", "$.k").alias("k"))
    text = F.concat(F.lit("Item: word"), F.min_by("k", "ord"), F.lit(" word"), F.max_by("k", "ord"))
    code = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])[F.col("event_type")]
    word = F.concat(F.lit(" Word"), F.col("k"))
    votes = events.select("user_id", "ord", code.alias("code"), F.array(word, F.upper(F.trim(word)), F.lit("w")).alias("words"))
    return votes.join(events.groupBy("user_id").agg(text.alias("text")), "user_id")


VOTE_SQL = """
e AS (SELECT user_id, event_type, event_id, value, json_extract_string(props, '$.k') AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
  FROM events),
t AS (SELECT user_id, 'item: word' || arg_min(k, n) || ' word' || arg_max(k, n) AS low FROM e GROUP BY user_id),
q AS (SELECT e.*, CASE event_type WHEN 'click' THEN 'y' WHEN 'view' THEN 'y' WHEN 'error' THEN 'u' ELSE 'n' END AS code, contains(low, 'word' || k) AS quoted FROM e JOIN t USING (user_id)),
c AS (SELECT user_id, count(*) FILTER (code = 'y') AS yes, count(*) FILTER (code = 'n') AS no, count(*) AS n,
  array_to_string(list_sort(list_distinct(list_concat(list(CASE WHEN quoted THEN 'word' || k END) FILTER (code = 'y' AND quoted), ['w']))), ',') AS ywords,
  array_to_string(list_sort(list_distinct(list_concat(list('word' || k) FILTER (code = 'n' AND quoted), ['w']))), ',') AS nwords FROM q GROUP BY user_id),
v AS (SELECT user_id, CASE WHEN yes >= 2 THEN 'yes' WHEN no >= 2 THEN 'no' ELSE 'unknown' END AS answer, CASE WHEN yes >= 2 THEN yes WHEN no >= 2 THEN no ELSE n - yes - no END AS agree,
  CASE WHEN yes >= 2 THEN ywords WHEN no >= 2 THEN nwords ELSE '' END AS words FROM c)"""


@REGISTRY.add("vote_route", f"WITH {VOTE_SQL} SELECT * FROM v")
def vote_route(spark, sf):
    return V.route_votes(vote_samples(spark, sf), "user_id", 2, 2).select("user_id", "answer", "agree", F.lower(F.array_join("words", ",")).alias("words"))


@REGISTRY.add("vote_candidate", """
WITH e AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
s AS (SELECT user_id, n, CASE WHEN event_type = 'error' THEN 'none' ELSE 'c' || (floor(value / 40)::INT % 4 + 1) END AS c, CASE WHEN event_type = 'view' THEN 'none' ELSE 'p' || (floor(value)::INT % 2 + 1) END AS p FROM e),
k AS (SELECT user_id, c, count(*) AS m, min(n) AS f FROM s WHERE c IN ('c1', 'c2', 'c3') GROUP BY user_id, c),
t AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY m DESC, f) = 1),
z AS (SELECT user_id, count(*) FILTER (c = 'none') AS nn, count(*) AS n FROM s GROUP BY user_id),
pk AS (SELECT s.user_id, s.p, count(*) AS m, min(s.n) AS f FROM s JOIN t ON s.user_id = t.user_id AND s.c = t.c WHERE p <> 'none' GROUP BY s.user_id, s.p),
pt AS (SELECT * FROM pk QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY m DESC, f) = 1)
SELECT z.user_id, CASE WHEN t.m >= 2 THEN substring(t.c, 2)::INT END AS candidate, CASE WHEN t.m >= 2 AND pt.m >= 2 THEN substring(pt.p, 2)::INT END AS portion,
  CASE WHEN t.m >= 2 THEN t.m WHEN nn = n THEN nn ELSE greatest(coalesce(t.m, 0), nn) END AS agree,
  CASE WHEN t.m >= 2 THEN '' WHEN nn = n THEN 'no candidate is the same food' ELSE 'readings do not agree on one record' END AS reason
FROM z LEFT JOIN t USING (user_id) LEFT JOIN pt USING (user_id)""")
def vote_candidate(spark, sf):
    c = F.when(F.col("event_type") == "error", "none").otherwise(F.concat(F.lit("c"), (F.floor(F.col("value") / 40) % 4 + 1).cast("string")))
    p = F.when(F.col("event_type") == "view", "none").otherwise(F.concat(F.lit("p"), (F.floor("value") % 2 + 1).cast("string")))
    votes = table(spark, sf, "events").select("user_id", F.struct("ts", "event_id").alias("ord"), c.alias("c"), p.alias("p"))
    return V.route_choices(votes, "user_id", F.lit(3), 2, 2)


TWO = replace(VoteRules(), attributes=("fried", "spicy"), agree_yes=2, agree_no=3)


def _tag_world(spark, sf):
    """Parts as items; readings for some of their texts, from their number."""
    k = F.col("p_partkey")
    items = table(spark, sf, "part").select(
        k.alias("id"), F.col("p_type").alias("section"), F.col("p_name").alias("name"),
        F.when(k % 4 == 0, F.col("p_brand")).otherwise("").alias("description"), F.lit("menu").alias("kind"))
    texts = plan.with_key(items).groupBy("key").agg(F.min("id").alias("m"), F.first("name").alias("name"))
    m = F.col("m")
    first = F.split("name", " ")[0]
    sample = lambda n: F.struct(
        F.when((m + n) % 5 != 4, F.concat(F.when((m + n) % 3 == 0, "n").otherwise("y"), F.when(m % 2 == 0, "n").otherwise("u"))).alias("a"),
        F.create_map(F.lit("fried"), F.array(F.when((m + n) % 7 == 0, "crispy").otherwise(F.upper(first)))).alias("w"),
        ((m + n) % 5 == 4).alias("refusal"))
    readings = texts.filter(m % 6 != 0).select("key", F.lit("b").alias("basis"), F.array(*[sample(n) for n in range(3)]).alias("samples"), m.alias("ord"))
    return items, readings


TAG_SQL = """
it AS (SELECT p_partkey AS id, string_split(p_name, ' ')[1] AS f, concat_ws(chr(10), 'Section: ' || p_type, 'Item: ' || p_name, CASE WHEN p_partkey % 4 = 0 THEN 'Description: ' || p_brand END) AS text FROM part),
kt AS (SELECT *, substring(sha256(text), 1, 20) AS text_hash FROM it), km AS (SELECT text_hash, min(id) AS m, any_value(f) AS f FROM kt GROUP BY text_hash),
sm AS (SELECT text_hash, m, f, unnest([0, 1, 2]) AS n FROM km WHERE m % 6 <> 0),
vt AS (SELECT text_hash, m, f, CASE WHEN (m + n) % 5 = 4 THEN 'u' WHEN (m + n) % 3 = 0 THEN 'n' ELSE 'y' END AS a, CASE WHEN (m + n) % 5 = 4 THEN 'u' WHEN m % 2 = 0 THEN 'n' ELSE 'u' END AS b, (m + n) % 7 <> 0 AS q FROM sm),
ag AS (SELECT text_hash, any_value(f) AS f, count(*) FILTER (a = 'y' AND q) AS y, count(*) FILTER (a = 'n') AS no, count(*) FILTER (a = 'n' AND q) AS nq, count(*) FILTER (b = 'n') AS bn FROM vt GROUP BY text_hash),
tg AS (SELECT text_hash, 'fried' AS attribute, CASE WHEN y >= 2 THEN 'yes' WHEN no >= 3 THEN 'no' ELSE 'unknown' END AS answer, CASE WHEN y >= 2 THEN y WHEN no >= 3 THEN no ELSE 3 - y - no END AS agree,
    CASE WHEN y >= 2 OR (no >= 3 AND nq > 0) THEN upper(f) ELSE '' END AS words FROM ag
  UNION ALL SELECT text_hash, 'spicy', CASE WHEN bn >= 3 THEN 'no' ELSE 'unknown' END, CASE WHEN bn >= 3 THEN bn ELSE 3 - bn END, '' FROM ag)"""


@REGISTRY.add("tag_table", f"WITH {TAG_SQL} SELECT id, text_hash, attribute, answer, agree, words FROM kt JOIN tg USING (text_hash)")
def tag_table(spark, sf):
    tags, _ = plan.tag_table(*_tag_world(spark, sf), "b", TWO)
    return tags.select("id", "text_hash", "attribute", "answer", "agree", F.array_join("words", ",").alias("words"))


@REGISTRY.add("tag_untagged", f"WITH {TAG_SQL} SELECT id, text_hash FROM kt WHERE text_hash IN (SELECT text_hash FROM km WHERE m % 6 = 0)")
def tag_untagged(spark, sf):
    return plan.tag_table(*_tag_world(spark, sf), "b", TWO)[1].select("id", "text_hash")


@REGISTRY.add("tag_distribution", f"""
WITH {TAG_SQL}, a AS (SELECT attribute, answer FROM kt JOIN tg USING (text_hash))
SELECT attribute, count(*) FILTER (answer = 'yes') AS yes, count(*) FILTER (answer = 'no') AS no, count(*) FILTER (answer = 'unknown') AS unknown, count(*) AS n,
  round(count(*) FILTER (answer = 'unknown') / count(*), 9) AS unknown_rate FROM a GROUP BY attribute""")
def tag_distribution(spark, sf):
    out = R.answer_distribution(tag_table(spark, sf))
    return out.withColumn("unknown_rate", F.round("unknown_rate", 9))


def _texts(spark, sf):
    docs = table(spark, sf, "documents")
    texts = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("kind"), text_hash(F.col("text")).alias("key"), "text")
    read = docs.join(table(spark, sf, "labels"), "doc_id", "left_semi").select(text_hash(F.col("text")).alias("key"), F.lit("b").alias("basis"))
    return texts, read


@REGISTRY.add("unread_items", """
WITH d AS (SELECT doc_id, substring(sha256(text), 1, 20) AS key, length(text) AS chars FROM documents)
SELECT key, any_value(chars) AS chars FROM d WHERE key NOT IN (SELECT key FROM d WHERE doc_id IN (SELECT doc_id FROM labels)) GROUP BY key""")
def unread_items(spark, sf):
    return plan.pending(*_texts(spark, sf), "b").select("key", F.length("text").alias("chars"))


@REGISTRY.add("unread_limited", """
WITH d AS (SELECT doc_id, source, substring(sha256(text), 1, 20) AS key FROM documents)
SELECT DISTINCT key FROM d WHERE source = 'src1' AND key NOT IN (SELECT key FROM d WHERE doc_id IN (SELECT doc_id FROM labels)) ORDER BY key LIMIT 7""")
def unread_limited(spark, sf):
    return plan.pending(*_texts(spark, sf), "b", kind="src1", limit=7).select("key")


def _reply(spark, sf):
    stop = F.when(F.col("event_type") == "error", "refusal").when(F.col("event_type") == "signup", "max_tokens").otherwise("end_turn")
    k = F.get_json_object("props", "$.k").cast("int")
    one = lambda answer, words: F.concat(F.lit('{"answer": "'), answer, F.lit('", "words": ['), words, F.lit("]}"))
    answer = F.when(k % 3 == 0, "yes").when(k % 3 == 1, "no").otherwise("unknown")
    whole = F.concat(F.lit('{"fried": '), one(answer, F.concat(F.lit('"w'), k.cast("string"), F.lit('", " "'))), F.lit(', "spicy": '), one(F.lit("no"), F.lit('""')), F.lit("}"))
    reply = F.when(k % 10 == 0, F.lit("not json")).when(k % 10 == 1, F.lit('{"fried": {"answer": "yes", "words": []}}')).otherwise(whole)
    choice = F.when(k % 10 == 0, F.lit('{"choice": "c1"}')).otherwise(F.concat(F.lit('{"choice": " c'), (k % 9).cast("string"), F.lit('", "portion": "p1 "}')))
    return table(spark, sf, "events").select("event_id", stop.alias("stop_reason"), reply.alias("reply"), choice.alias("choice_reply"))


_REPLY_SQL = """
e AS (SELECT event_id, event_type, json_extract_string(props, '$.k')::INT AS k, CASE event_type WHEN 'error' THEN 'refusal' WHEN 'signup' THEN 'max_tokens' ELSE 'end_turn' END AS stop FROM events)"""


@REGISTRY.add("reading_parse", f"""
WITH {_REPLY_SQL}, o AS (SELECT *, stop = 'end_turn' AND k % 10 > 1 AS ok FROM e)
SELECT event_id, stop = 'refusal' AS refusal, CASE WHEN ok THEN CASE k % 3 WHEN 0 THEN 'yn' WHEN 1 THEN 'nn' ELSE 'un' END END AS a,
  CASE WHEN ok THEN CASE WHEN k % 3 < 2 THEN 'w' || k ELSE '' END END AS fried_words,
  CASE WHEN stop = 'refusal' OR ok THEN NULL WHEN stop <> 'end_turn' THEN 'stop_reason ' || stop ELSE 'unparseable reading' END AS problem FROM o""")
def reading_parse(spark, sf):
    out = V.parse_tag_replies(_reply(spark, sf), TWO)
    words = F.when(F.col("a").isNotNull(), F.coalesce(F.array_join(F.col("w")["fried"], ","), F.lit("")))
    return out.select("event_id", "refusal", "a", words.alias("fried_words"), "problem")


@REGISTRY.add("choice_parse", f"""
WITH {_REPLY_SQL}, o AS (SELECT *, stop = 'end_turn' AND k % 10 <> 0 AS ok FROM e)
SELECT event_id, stop = 'refusal' AS refusal, CASE WHEN ok THEN 'c' || (k % 9) END AS c, CASE WHEN ok THEN 'p1' END AS p,
  CASE WHEN stop = 'refusal' OR ok THEN NULL WHEN stop <> 'end_turn' THEN 'stop_reason ' || stop ELSE 'unparseable reading' END AS problem FROM o""")
def choice_parse(spark, sf):
    replies = _reply(spark, sf).select("event_id", "stop_reason", F.col("choice_reply").alias("reply"))
    return V.parse_choice_replies(replies).select("event_id", "refusal", "c", "p", "problem")


@REGISTRY.add("quote_filter", """
WITH w AS (SELECT conv_id, turn, lower(text) AS low, trim(substring(text, 3, 6)) AS a, substring(text, 1, 4) AS b FROM conversations)
SELECT conv_id, turn, CASE WHEN a <> '' AND a NOT LIKE '%ß%' THEN a ELSE '' END AS fried, 0 AS spicy FROM w""")
def quote_filter(spark, sf):
    """Quoted words of a sample kept when the text holds them: one taken from it, one foreign."""
    t = F.col("text")
    words = F.create_map(F.lit("fried"), F.array(F.upper(F.substring(t, 3, 6)), F.lit("zzqq-9"), F.lit(" ")), F.lit("spicy"), F.array(F.lit("zzqq-9")))
    kept = V.only_item_words(words, t)
    return table(spark, sf, "conversations").select("conv_id", "turn", kept.alias("w"), "text").select(
        "conv_id", "turn", F.coalesce(F.when(F.size(F.col("w")["fried"]) > 0, F.trim(F.substring("text", 3, 6))), F.lit("")).alias("fried"),
        F.when(F.col("w")["spicy"].isNull(), 0).otherwise(1).alias("spicy"))


@REGISTRY.add("latest_reading", """
SELECT user_id, event_type, arg_max(event_id, struct_pack(t := ts, e := event_id)) AS event_id FROM events GROUP BY 1, 2""")
def latest_reading(spark, sf):
    return latest_rows(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@REGISTRY.add("readings_upsert", """
WITH s AS (SELECT c_custkey AS key, 'b' || (c_nationkey % 2) AS basis, c_acctbal AS v FROM customer),
n AS (SELECT s_suppkey AS key, 'b' || (s_nationkey % 2) AS basis, s_acctbal AS v FROM supplier)
SELECT key, basis, v FROM n UNION ALL SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.key = s.key AND n.basis = s.basis)""")
def readings_upsert(spark, sf):
    basis = lambda c: F.concat(F.lit("b"), (F.col(c) % 2).cast("string")).alias("basis")
    stored = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), basis("c_nationkey"), F.col("c_acctbal").alias("v"))
    new = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), basis("s_nationkey"), F.col("s_acctbal").alias("v"))
    return upsert_readings(stored, new)


def _confusion(spark, sf):
    labels = table(spark, sf, "labels")
    left = labels.select("doc_id", F.col("quality").alias("answer"))
    right = labels.filter(F.col("doc_id") % 9 != 0).select("doc_id", F.col("toxic").alias("answer"))
    return R.agreement(left, right, ["doc_id"], "answer")


@REGISTRY.add("label_agreement", "SELECT quality AS pinned, CASE WHEN doc_id % 9 <> 0 THEN toxic END AS other, count(*) AS n FROM labels GROUP BY 1, 2")
def label_agreement(spark, sf):
    return _confusion(spark, sf)


@REGISTRY.add("agreement_rate", """
SELECT count(*) FILTER (doc_id % 9 <> 0 AND quality = toxic) AS same, count(*) AS total, round(count(*) FILTER (doc_id % 9 <> 0 AND quality = toxic) / count(*), 9) AS rate FROM labels""")
def agreement_rate(spark, sf):
    return R.agreement_rate(_confusion(spark, sf)).withColumn("rate", F.round("rate", 9))


@REGISTRY.add("map_agreement", """
SELECT count(*) FILTER (p_partkey % 3 <> 0 OR p_partkey % 2 = 0) AS same, count(*) AS total FROM part""")
def map_agreement(spark, sf):
    k = F.col("p_partkey")
    left = table(spark, sf, "part").select(k.alias("id"), F.col("p_type").alias("kind"), F.when(k % 3 == 0, k).alias("fdcId"))
    right = table(spark, sf, "part").select(k.alias("id"), F.col("p_type").alias("kind"), F.when((k % 3 == 0) & (k % 2 == 0), k).alias("fdcId"))
    return R.map_agreement(left, right)


@REGISTRY.add("usage_cost", """
WITH u AS (SELECT event_type AS model, sum(floor(value))::BIGINT AS input, sum(event_id % 7)::BIGINT AS cache_write, sum(event_id % 11)::BIGINT AS cache_read, sum(event_id % 5)::BIGINT AS output FROM events GROUP BY 1)
SELECT model, input, cache_write, cache_read, output, round((input * p + cache_write * p * 1.25::DOUBLE + cache_read * p * 0.1::DOUBLE + output * q) / 1e6 * 0.5, 9) AS cost
FROM u JOIN (VALUES ('click', 5.0::DOUBLE, 25.0::DOUBLE), ('view', 1.0::DOUBLE, 5.0::DOUBLE), ('purchase', 2.0::DOUBLE, 10.0::DOUBLE)) t(m, p, q) ON m = model""")
def usage_cost(spark, sf):
    usage = table(spark, sf, "events").select(
        F.col("event_type").alias("model"), F.floor("value").alias("input"), (F.col("event_id") % 7).alias("cache_write"),
        (F.col("event_id") % 11).alias("cache_read"), (F.col("event_id") % 5).alias("output"))
    prices = R.price_table(spark, {"click": (5.0, 25.0), "view": (1.0, 5.0), "purchase": (2.0, 10.0)})
    return R.usage_cost(usage, prices, "model").withColumn("cost", F.round("cost", 9))
