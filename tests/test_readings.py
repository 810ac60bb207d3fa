"""Votes, tags, food map, nutrients, quality rules: canonical cases."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from larderline.config import DocumentRules, NutrientRules, VerdictRules, VoteRules
from larderline.operators import nutrients as N
from larderline.operators import quality as Q
from larderline.operators.retrieval import record_kind
from larderline.operators.votes import route_answer, route_choice
from larderline.plans import readings as plan


@pytest.mark.parametrize("text, samples, want", [
    ("Item: Fried Calamari", [("y", ["Fried"]), ("y", ["Fried Calamari"]), ("u", [])], ("yes", 2, ["Fried", "Fried Calamari"])),
    ("Item: Fried Calamari", [("y", ["Fried"]), ("u", []), ("u", [])], ("unknown", 2, [])),
    ("Item: Calamari", [("y", ["crispy"]), ("y", ["deep fried"]), ("y", ["fried"])], ("unknown", 3, [])),
    ("Item: Green Salad", [("n", ["Green Salad"]), ("n", ["Salad"]), ("u", [])], ("unknown", 1, [])),
    ("Item: Green Salad", [("n", ["Salad"]), ("n", []), ("n", None)], ("no", 3, ["Salad"])),
    ("Item: Nut bar", [("y", [" nut "]), ("y", ["NUT"]), ("n", [])], ("yes", 2, ["nut"])),
])
def test_route_answer(spark, text, samples, want):
    df = spark.createDataFrame([(text, samples)], "t string, s array<struct<code:string,words:array<string>>>")
    assert tuple(df.select(route_answer(F.col("s"), F.col("t"), 2, 3).alias("r")).first().r) == want


@pytest.mark.parametrize("samples, want", [
    ([("c3", "p1"), ("c3", "p1"), ("c3", "none")], (3, 1, 3, "")),
    ([("c3", "p1"), ("c3", "p1"), ("c5", "none")], (None, None, 2, "readings do not agree on one record")),
    ([("c3", "p1"), ("c3", "p2"), ("c3", "none")], (3, None, 3, "")),
    ([("c30", "none")] * 3, (None, None, 0, "readings do not agree on one record")),
    ([("none", "none")] * 3, (None, None, 3, "no candidate is the same food")),
    ([("refused", "none"), ("none", "none"), ("c1", "p1")], (None, None, 1, "readings do not agree on one record")),
])
def test_route_choice(spark, samples, want):
    df = spark.createDataFrame([(samples,)], "s array<struct<c:string,p:string>>")
    assert tuple(df.select(route_choice(F.col("s"), F.lit(16), 3, 2).alias("r")).first().r) == want


def test_every_item_is_tagged_or_listed(spark):
    rules = replace(VoteRules(), attributes=("fried", "raw"))
    items = spark.createDataFrame([("a", "S", "Fried fish", ""), ("b", "S", "Fried fish", ""), ("c", "", "Soup", "")], "id string, section string, name string, description string")
    key = plan.with_key(items).filter("id = 'a'").first().key
    readings = spark.createDataFrame([
        (key, "old", [("nn", None, None)] * 3, 9), (key, "now", [("uu", None, None)] * 3, 1),
        (key, "now", [("yu", {"fried": ["fried"]}, None), ("yn", {"fried": ["Fried"]}, None), (None, None, True)], 2)],
        "key string, basis string, samples array<struct<a:string,w:map<string,array<string>>,refusal:boolean>>, ord int")
    tags, untagged = plan.tag_table(items, readings, "now", rules)
    got = {(r.id, r.attribute): (r.answer, r.agree, r.words) for r in tags.collect()}
    assert got == {("a", "fried"): ("yes", 2, ["fried"]), ("b", "fried"): ("yes", 2, ["fried"]), ("a", "raw"): ("unknown", 2, []), ("b", "raw"): ("unknown", 2, [])}
    assert [r.id for r in untagged.collect()] == ["c"]


FIELDS = list(NutrientRules().fields)


@pytest.mark.parametrize("amounts, energy, fiber, sugars", [
    ({1003: "22.5", 1004: "2.62", 1005: "0", 1008: "120", 1079: "0", 1093: "45", 1258: "0.563", 2000: "0"}, (120.0, 1008), (0.0, 1079), (0.0, 2000)),
    ({1003: "3.546875", 1063: "0.5569", 1079: "0.0", 2047: "38.485", 2048: "38.485"}, (38.485, 2047), (0.0, 1079), (0.5569, 1063)),
    ({1003: "0.66875", 1063: "2.618", 1093: "9.948"}, (None, None), (None, None), (2.618, 1063)),
    ({1008: "", 2047: None, 2048: "7"}, (7.0, 2048), (None, None), (None, None)),
])
def test_nutrient_fallback(spark, amounts, energy, fiber, sugars):
    rows = [(1, i, v, n) for n, (i, v) in enumerate(amounts.items())]
    r = N.nutrient_rows(spark.createDataFrame(rows, "f int, n int, a string, o int"), "f", "n", "a", "o").first()
    for field, want in (("energy_kcal", energy), ("fiber_g", fiber), ("sugars_g", sugars)):
        assert (r.per_100g[field], r.nutrient_ids[field]) == want


def test_numbers_resolve_to_the_first_wanted_id(spark):
    nutrient = spark.createDataFrame([("r", "1063", "269"), ("r", "2000", "269.0"), ("r", "1008", "208"), ("q", "1063", "269")], "release string, id string, nutrient_nbr string")
    rows = spark.createDataFrame([("r", "269", 1), ("r", "208.0", 2), ("q", "269", 3), ("r", "1003", 4), ("r", "9999", 5), ("r", "301", 6)], "release string, nutrient_id string, i int")
    assert {r.i: r.nid for r in N.resolve_codes(rows, nutrient).collect()} == {1: 2000, 2: 1008, 3: 1063, 4: 1003}


@pytest.mark.parametrize("fat, count", [(52.54, 0), (120.0, 2)])
def test_nutrient_bounds(spark, fat, count):
    row = {"energy_kcal": 598.0, "protein_g": 20.96, "fiber_g": 10.9, "sodium_mg": 3.0, "sugars_g": 4.86, "fat_g": fat, "saturated_fat_g": 4.092, "carbohydrate_g": 21.01}
    df = spark.createDataFrame([(1, *[row[f] for f in FIELDS])], "food int, " + ", ".join(f"{f} double" for f in FIELDS))
    assert Q.nutrient_bounds(df, "food").count() == count


@pytest.mark.parametrize("data_type, category, want", [
    ("Survey (FNDDS)", "Pizza", "usda-mixed-dish-estimate"), ("Survey (FNDDS)", "Dried fruits", "usda-single-food"),
    ("SR Legacy", "Pizza", "usda-single-food"), ("Survey (FNDDS)", None, "usda-single-food")])
def test_record_kind(spark, data_type, category, want):
    df = spark.createDataFrame([(data_type, category)], "d string, c string")
    assert df.select(record_kind(F.col("d"), F.col("c")).alias("k")).first().k == want


@pytest.mark.parametrize("today, want", [("2026-10-01", "current"), ("2027-03-01", "due-soon"), ("2027-03-21", "due-soon"), ("2027-03-22", "stale"), ("2027-02-18", "current"), ("2027-02-19", "due-soon")])
def test_age(spark, today, want):
    df = spark.createDataFrame([("2026-09-22",)], "d string")
    r = df.select(Q.age_status(F.col("d").cast("date"), today, 180, 30).alias("a")).first().a
    assert (r.status, str(r.due)) == (want, "2027-03-21")


def test_extension_turns_stale_into_a_warning(spark):
    docs = spark.createDataFrame([("a", "2025-01-01", 3), ("b", "2025-01-01", 3), ("c", "2025-01-01", 0)], "slug string, as_of string, rows int")
    ext = spark.createDataFrame([("a", "2026-12-31")], "slug string, until string")
    assert {(r.key, r.severity) for r in Q.freshness(docs, "2026-10-01", ext).collect()} == {("a", "warn"), ("b", "fail")}


@pytest.mark.parametrize("verdict, verified, want", [
    ("pick", "2026-08-31", []), ("pick", None, ["fail"]), ("ok", "2025-08-31", ["fail"]), ("great", "2026-08-31", ["fail"]), ("ok", "2025-10-10", ["warn"]), (None, None, [])])
def test_verdicts(spark, verdict, verified, want):
    df = spark.createDataFrame([("x", verdict, verified)], "name string, verdict string, verified string")
    assert [r.severity for r in Q.verdicts(df, "2026-10-01", VerdictRules()).collect()] == want


def shape(spark, doc, file="case.json"):
    keys = spark.createDataFrame([("Case Cafe",)], "key string")
    df = spark.createDataFrame([(file, json.dumps(doc))], "file string, doc string")
    return [r.rule for r in Q.document_shape(df, keys, DocumentRules()).collect()]


def test_document_shape(spark):
    item = {"section": "Mains", "item": "Soup", "price": 9.0, "description": "tomato"}
    doc = {"name": "Case Cafe", "source": "case", "as_of": "2026-10-01", "status": "ok", "items": [item], "extraction": {"model": "m", "prompt_hash": "h"}}
    assert shape(spark, doc) == []
    assert shape(spark, {**doc, "extraction": None}) == ["no-extraction-basis"]
    assert shape(spark, {**doc, "as_of": "2026-09-01", "extraction": None, "items": [{**item, "price": "9"}, {**item, "x": 1}]}) == ["malformed-row"]
    assert shape(spark, {**doc, "items": [{**item, "price": None}, {**item, "price": 3}]}) == []
    assert shape(spark, {**doc, "extraction": {"method": "script"}}) == ["script-without-path"]
    product = {k: None for k in DocumentRules().product_fields} | {"name": "Tea", "price": 1.5}
    rest = {k: v for k, v in doc.items() if k != "items"}
    assert shape(spark, {**rest, "products": [product]}) == []
    assert shape(spark, {**rest, "products": [{**product, "name": " "}], "name": "Else", "status": "new"}) == ["unknown-place", "status", "malformed-row"]


@pytest.mark.parametrize("name, change, want", [("1.json", {}, []), ("1.json", {"fetched_at": ""}, ["record-dated"]), ("2.json", {}, ["record-dated"]), ("1.json", {"x": 1}, ["record-fields"])])
def test_record_cache(spark, name, change, want):
    doc = {"fdcId": 1, "dataType": "SR Legacy", "description": "d", "publicationDate": "4/1/2019", "fetched_at": "2026-09-23", "nutrients": [], "portions": []}
    df = spark.createDataFrame([(name, json.dumps({**doc, **change}))], "file string, doc string")
    assert [r.rule for r in Q.record_cache(df).collect()] == want


def test_layer_keys(spark):
    places = spark.createDataFrame([("A", "A", "North Beach")], "key string, name string, neighborhood string")
    layer = lambda *ks: spark.createDataFrame([(k,) for k in ks], "key string")
    assert Q.layer_keys(places, layer("A"), layer("A")).count() == 0
    assert [(r.rule, r.key) for r in Q.layer_keys(places, layer("A", "B"), layer()).collect()] == [("orphan-risk", "B")]


def test_pattern_scan_positions(spark):
    text = "first\nwrite to ann@gmail.com or bob@gmail.com\n\nEND health_food health " + "x" * 50
    df = spark.createDataFrame([("a/1", text), ("free/1", text)], "path string, text string")
    from larderline.config import EMAIL_PATTERNS, TOPIC_PATTERNS
    rows = Q.pattern_scan(df, [*EMAIL_PATTERNS, *TOPIC_PATTERNS], exempt=("free/",)).collect()
    assert sorted((r.line, r.label, r.match) for r in rows) == [(2, "personal email", "ann@gmail.com"), (2, "personal email", "bob@gmail.com"), (4, "health", "health")]
    at = text.index("health ")
    assert {r.context for r in rows if r.label == "health"} == {text[at - 30:at + 6 + 30]}


def test_food_map_rejections(spark):
    rows = spark.createDataFrame([
        ("a", "guess", None, None, None, None, None, None), ("b", "label", None, None, None, 5.0, None, None), ("c", "unmapped", None, 7, None, None, None, None),
        ("d", "usda-single-food", False, 7, "Survey (FNDDS)", 1.0, "Pizza", None), ("e", "usda-single-food", False, 7, "SR Legacy", 0.0, "x", None),
        ("f", "usda-single-food", True, 7, "SR Legacy", None, "x", None), ("zz", "unmapped", None, None, None, None, None, "r")],
        "id string, kind string, estimate boolean, fdcId int, dataType string, grams double, category string, reason string")
    items = spark.createDataFrame([(i, "menu" if i == "f" else "product") for i in "abcdefgh"], "id string, kind string")
    unread = spark.createDataFrame([("g", "")], "id string, reason string")
    labels = spark.createDataFrame([("x",)], "id string")
    got = sorted((r.rule, r.key) for r in Q.food_map(rows, unread, items, labels).collect())
    assert got == [("item-not-mapped", "h"), ("map-grams", "e"), ("map-kind", "a"), ("map-label", "b"), ("map-record", "d"),
                   ("map-unmapped", "c"), ("map-without-item", "zz"), ("unread-reason", "g")]
