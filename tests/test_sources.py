"""Readers and jobs on small files, written fresh for each test."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from larderline.operators import items as I
from larderline.operators.quality import document_shape
from larderline.plans import inspections as insp_plan
from larderline.plans import nutrients as nut_plan
from larderline.plans import place_index
from larderline.plans import readings as read_plan
from larderline.sources import readers, schemas, writers


def put(path, doc):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(doc, ensure_ascii=False))
    return str(path)


def put_csv(path, schema, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    names = [f.split()[0] for f in schema.split(", ")]
    with path.open("w", newline="") as f:
        w = csv.DictWriter(f, names, restval="")
        w.writeheader()
        w.writerows(rows)
    return str(path)


SQUARE = [[[-122.42, 37.79], [-122.40, 37.79], [-122.40, 37.81], [-122.42, 37.81], [-122.42, 37.79]]]


def geo(tmp_path):
    return put(tmp_path / "areas.json", {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "North Beach", "kind": "analysis_neighborhood"}, "geometry": {"type": "MultiPolygon", "coordinates": [SQUARE]}},
        {"type": "Feature", "properties": {"name": "Elsewhere", "kind": "analysis_neighborhood"}, "geometry": {
            "type": "Polygon", "coordinates": [[[-122.50, 37.70], [-122.40, 37.70], [-122.40, 37.80], [-122.50, 37.80]]]}},
        {"type": "Feature", "properties": {"name": "line", "kind": "split_line"}, "geometry": {"type": "LineString", "coordinates": [[-122.42, 37.805], [-122.40, 37.806]]}}]})


def test_place_index_from_files(spark, tmp_path):
    node = lambda i, name, lat, lon, **tags: {"type": "node", "id": i, "lat": lat, "lon": lon, "tags": {"name": name, **tags}}
    raw = put(tmp_path / "raw.json", {"elements": [
        node(1, "Café Uno", 37.8000, -122.4100, amenity="cafe", cuisine="coffee_shop"),
        {"type": "way", "id": 2, "center": {"lat": 37.8005, "lon": -122.4100}, "tags": {"name": "Cafe Uno", "amenity": "cafe"}},
        node(3, "CAFE UNO", 37.8080, -122.4100, amenity="cafe", **{"addr:housenumber": "5", "addr:street": "Bay St"}),
        node(4, "Flowers", 37.80, -122.41, shop="florist"), node(5, "Tea", 37.7999, -122.4101, shop="tea"),
        {"type": "node", "id": 6, "lat": 37.8, "lon": -122.41, "tags": {"amenity": "cafe"}}, {"type": "node", "id": 7, "tags": {"name": "No point", "amenity": "cafe"}}]})
    curated = put(tmp_path / "curated.json", {
        "overrides": {"cafe uno": {"price": 2, "verdict": "ok", "verified": "2026-08-31"}},
        "extras": [{"name": "Cafe Uno", "category": "cafe", "subtype": "cafe", "addr": "x", "lat": 37.8001, "lon": -122.4100, "price": 4}]})
    base = put(tmp_path / "base.json", [
        {"osm_type": "node", "osm_id": 9, "name": "Far Deli", "category": "grocery", "subtype": "deli", "lat": 37.75, "lon": -122.45},
        {"osm_type": "node", "osm_id": 8, "name": "Near Deli", "category": "grocery", "subtype": "deli", "lat": 37.8001, "lon": -122.4111, "addr": None},
        {"osm_type": "node", "osm_id": 7, "name": "Tea", "category": "grocery", "subtype": "deli", "lat": 37.8000, "lon": -122.4101}])
    feats = readers.features(spark, geo(tmp_path))
    built = place_index.build(readers.poi_elements(spark, raw), readers.extras(spark, curated), readers.poi_base(spark, base),
                              readers.overlay(spark, curated), readers.polygons(feats), readers.split_line(feats))
    got = {(r.key, r.neighborhood, r.price, r.category) for r in built.collect()}
    assert got == {("Café Uno", "North Beach", 2, "cafe"), ("CAFE UNO (5 Bay St)", "Fisherman's Wharf", 2, "cafe"), ("Tea", "North Beach", None, "grocery"),
                   ("Cafe Uno", "North Beach", 4, "cafe"), ("Near Deli", "North Beach", None, "grocery")}


def test_incident_pull(spark, tmp_path):
    path = put(tmp_path / "pull.json", {"source": "s", "fetched_at": "2026-09-22", "poi_bbox": [1.0, 2.0, 3.0, 4.0], "rows": [
        {"row_id": "1", "incident_id": "7", "incident_category": "Assault", "latitude": "37.8", "longitude": "-122.4"}, {"row_id": "2"}]})
    assert [(r.row_id, r.incident_id, r.latitude) for r in readers.incidents(spark, path).collect()] == [("1", "7", "37.8"), ("2", None, None)]
    assert readers.incident_pull(spark, path).first().poi_bbox == [1.0, 2.0, 3.0, 4.0]


def test_menus_products_and_item_table(spark, tmp_path):
    menu = {"name": "Case Cafe", "source": "m", "as_of": "2026-09-22", "status": "ok", "menu_url": None, "items": [
        {"section": "Mains", "item": "Crème Soup", "price": 9, "description": "x"}, {"section": None, "item": "Crème Soup", "price": None, "description": None}]}
    put(tmp_path / "menus/case-cafe.json", menu)
    put(tmp_path / "menus/index.json", [{"name": "x"}])
    put(tmp_path / "products/store.json", {"name": "Store", "source": "p", "as_of": "2026-09-23", "status": "ok", "products": [
        {"section": "A", "name": "Rice", "size": "16 Oz", "price": 2.5, "sold_by": "weight", "package_g": 453.6, "package_ml": None, "units": None}]})
    menus = readers.menus(spark, str(tmp_path / "menus"))
    assert [(r.slug, r.items_count) for r in I.manifest(menus).collect()] == [("case-cafe", 2)]
    rows = I.with_ids(I.menu_items(menus).unionByName(I.product_items(readers.product_lists(spark, str(tmp_path / "products")))))
    got = {(r.id, r.kind, r.section, r.price, r.size) for r in rows.collect()}
    assert got == {("case-cafe--creme-soup", "menu", "", None, ""), ("case-cafe--creme-soup-2", "menu", "Mains", 9.0, ""), ("store--rice", "product", "A", 2.5, "16 Oz")}
    texts = readers.document_texts(spark, str(tmp_path / "menus")).filter("file <> 'index.json'")
    assert document_shape(texts, spark.createDataFrame([("Case Cafe",)], "key string")).count() == 0


def test_inspection_job_from_csv(spark, tmp_path):
    a = put_csv(tmp_path / "a.csv", schemas.SCORED, [
        {"business_id": "1", "business_name": "GOLDEN LANTERN", "business_address": "700 GRANT AVE", "postal": "94108", "inspection_id": "1_1", "inspection_date": "2018-01-02",
         "inspection_score": "88", "inspection_type": "Routine", "violation_description": 'A "quoted", text\nover lines', "risk_category": "High Risk"},
        {"business_id": "1", "business_name": "later name", "inspection_id": "1_1", "inspection_date": "2019-09-09", "violation_description": "B", "risk_category": "Low Risk"}])
    b = put_csv(tmp_path / "b.csv", schemas.PLACARD, [
        {"inspection_id": "9", "name": "Golden Lantern", "address": "700 Grant Ave", "date": "2021-05-05", "facility_status": "CONDITIIONAL PASS", "violation_observed": "Major - x", "description": "d"}])
    c = put_csv(tmp_path / "c.csv", schemas.CURRENT, [
        {"permit_number": "5", "dba": "Golden Lantern", "street_address": "700 Grant Ave", "inspection_date": "2025-02-02", "facility_rating_status": "PASS", "violation_count": "2.0", "violation_codes": "114119.1 x"},
        {"permit_number": "5", "dba": "Golden Lantern", "street_address": "700 Grant Ave", "inspection_date": "2025-02-02", "inspection_type": "Routine", "facility_rating_status": "Pass", "violation_count": "2", "violation_codes": "114119.1"},
        {"permit_number": "5", "dba": "Golden Lantern", "street_address": "700 Grant Ave", "inspection_date": "2030-01-01", "facility_rating_status": "CLOSURE"}])
    places = spark.createDataFrame([("k", "Golden Lantern", "700 Grant Avenue", 37.79, -122.40), ("n", "Other", "", 37.79, -122.40)], "key string, name string, addr string, lat double, lon double")
    layer, found = insp_plan.inspection_layer(places, readers.scored_inspections(spark, a), readers.placard_inspections(spark, b),
                                              readers.current_inspections(spark, c), "2026-09-22")
    rows = {r.key: r for r in layer.collect()}
    k = rows["k"]
    assert rows["n"].match_confidence == "none" and rows["n"].inspections_total is None
    assert (k.match_confidence, k.registrations, k.inspections_total, k.last_status, k.conditional_pass_all_time, k.closures_all_time) == ("name+address", 3, 3, "Pass", 1, 0)
    assert (k.last_score, str(k.worst_score_date), k.high_risk_count_all_time, k.violation_count_last, k.last_violation_codes) == (88, "2018-01-02", 2, 2, ["114119.1"])
    assert {r.match_confidence: r.places for r in insp_plan.confidence_report(layer).collect()} == {"name+address": 1, "none": 1}
    assert {r.dataset_range for r in rows.values()} == {"2018-01-02..2025-02-02"}
    assert found.rejected.count() == 0


def test_readings_last_line_wins_and_upsert(spark, tmp_path):
    path = tmp_path / "pins.jsonl"
    line = lambda key, basis, c: json.dumps({"key": key, "basis": basis, "models": ["m"], "samples": [{"c": c, "p": "none"}]})
    path.write_text("\n".join([line("a", "x", "c1"), "", line("a", "x", "c2"), line("a", "y", "c3"), line("b", "x", "none"), ""]))
    stored = readers.map_readings(spark, str(path))
    assert {r.key: r.samples[0].c for r in read_plan.current(stored, "x").collect()} == {"a": "c2", "b": "none"}
    new = stored.filter("key = 'b'").withColumn("basis", F.lit("z"))
    assert writers.upsert_readings(stored.filter("samples[0].c <> 'c1'"), new).count() == 4


def test_food_index_and_nutrients_from_bulk(spark, tmp_path):
    found, legacy, survey = list(readers.FOOD_RELEASES)
    for rel in (found, legacy, survey):
        d = tmp_path / rel / "inner"
        put_csv(d / "nutrient.csv", "id string, name string, nutrient_nbr string", [{"id": "1008", "nutrient_nbr": "208"}, {"id": "2000", "nutrient_nbr": "269"}, {"id": "1063", "nutrient_nbr": "269"}])
        put_csv(d / "measure_unit.csv", schemas.BULK["measure_unit"], [{"id": "1", "name": "cup"}, {"id": "2", "name": "undetermined"}])
        if rel == survey:
            put_csv(d / "wweia_food_category.csv", schemas.BULK["wweia_food_category"], [{"wweia_food_category": "7", "wweia_food_category_description": "Pizza"}])
        else:
            put_csv(d / "food_category.csv", schemas.BULK["food_category"], [{"id": "7", "description": 'Fruits, "dried"'}])
    put_csv(tmp_path / legacy / "inner/food.csv", "fdc_id string, data_type string, description string, food_category_id string", [
        {"fdc_id": "10", "data_type": "sr_legacy_food", "description": "Fig, raw", "food_category_id": "7"}, {"fdc_id": "11", "data_type": "sample_food", "description": "x"}])
    put_csv(tmp_path / survey / "inner/food.csv", "fdc_id string, data_type string, description string, food_category_id string", [
        {"fdc_id": "20", "data_type": "survey_fndds_food", "description": "Pizza", "food_category_id": "7"}])
    put_csv(tmp_path / found / "inner/food.csv", "fdc_id string, data_type string, description string, food_category_id string", [])
    portion = "id string, fdc_id string, amount string, measure_unit_id string, portion_description string, modifier string, gram_weight string"
    put_csv(tmp_path / legacy / "inner/food_portion.csv", portion, [
        {"fdc_id": "10", "amount": "1.0", "measure_unit_id": "1", "modifier": " sliced ", "gram_weight": "30.25"}, {"fdc_id": "10", "amount": "2", "measure_unit_id": "2", "gram_weight": "8"},
        {"fdc_id": "10", "amount": "9", "gram_weight": ""}])
    put_csv(tmp_path / survey / "inner/food_portion.csv", portion, [{"fdc_id": "20", "measure_unit_id": "2", "portion_description": " 1 slice ", "modifier": "64449", "gram_weight": "100"}])
    put_csv(tmp_path / found / "inner/food_portion.csv", portion, [])
    amount = "id string, fdc_id string, nutrient_id string, amount string"
    put_csv(tmp_path / legacy / "inner/food_nutrient.csv", amount, [{"fdc_id": "10", "nutrient_id": "1008", "amount": "74"}, {"fdc_id": "10", "nutrient_id": "1063", "amount": "16"}])
    put_csv(tmp_path / survey / "inner/food_nutrient.csv", amount, [{"fdc_id": "20", "nutrient_id": "208", "amount": "0"}, {"fdc_id": "20", "nutrient_id": "269", "amount": "4"}])
    put_csv(tmp_path / found / "inner/food_nutrient.csv", amount, [])
    index = {r.fdcId: r for r in nut_plan.index(spark, str(tmp_path)).collect()}
    assert [(p.label, p.grams) for p in index[10].portions] == [("1.0 cup sliced", 30.2), ("2", 8.0)] and index[10].category == 'Fruits, "dried"'
    assert [(p.label, p.grams) for p in index[20].portions] == [("1 slice", 100.0)] and index[20].category == "Pizza"
    mapped = spark.createDataFrame([(10,), (20,)], "fdcId long")
    rows = {r.fdcId: r for r in nut_plan.table(spark, str(tmp_path), mapped).collect()}
    assert (rows[10].per_100g.energy_kcal, rows[10].per_100g.sugars_g, rows[10].nutrient_ids.sugars_g, rows[10].per_100g.fat_g) == (74.0, 16.0, 1063, None)
    assert (rows[20].per_100g.energy_kcal, rows[20].nutrient_ids.energy_kcal, rows[20].nutrient_ids.sugars_g) == (0.0, 1008, 2000)


def test_records_labels_and_grocery(spark, tmp_path):
    put(tmp_path / "rec/10.json", {"fdcId": 10, "dataType": "SR Legacy", "nutrients": [{"id": 1008, "amount": 74}], "portions": []})
    put(tmp_path / "lab/x.json", {"id": "x", "serving_g": 28, "nutrients": [{"name": "Sodium", "unit": "mg", "amount": 140}]})
    put(tmp_path / "g.json", {"rows": [{"food": "fig", "fdcId": 10}]})
    assert readers.food_records(spark, str(tmp_path / "rec")).first().slug == "10"
    assert readers.labels(spark, str(tmp_path / "lab")).first().serving_g == 28.0
    assert [tuple(r) for r in readers.grocery_foods(spark, str(tmp_path / "g.json")).collect()] == [("fig", 10)]


def test_whole_food_map_with_retrieval(spark):
    foods = spark.createDataFrame([
        (1, "SR Legacy", "Avocados, raw", "Fruits", [("1 cup", 150.0)]), (2, "Survey (FNDDS)", "Avocado, raw", "Other fruits", [("1 fruit", 200.0)]),
        (3, "Survey (FNDDS)", "Pork, sweet and sour", "Meat mixed dishes", [("1 cup", 226.0)])],
        "fdcId int, dataType string, description string, category string, portions array<struct<label:string,grams:double>>")
    items = spark.createDataFrame([
        ("a", "product", "Fruits", "Hass Avocado", "", "16 Oz"), ("p", "menu", "", "Sweet And Sour Pork", "", ""), ("n", "menu", "Prix Fixe", "4 Courses", "", ""),
        ("l", "product", "", "Avocado oil", "", ""), ("u", "menu", "", "Raw bar", "", "")], "id string, kind string, section string, name string, description string, size string")
    inputs = read_plan.map_inputs(items, foods)
    asked = {r.id: r for r in inputs.collect()}
    assert asked["p"].question == "Item: Sweet And Sour Pork\nKind: restaurant or cafe menu item\n\nCandidates:\nc1 [DISH] Pork, sweet and sour | portions: p1 1 cup (226 g)"
    vote = lambda key, c, p: (key, "b", [(c, p, None)] * 3, 1)
    readings = spark.createDataFrame([vote(asked["a"].key, "c1", "none"), vote(asked["p"].key, "c1", "p1")], "key string, basis string, samples array<struct<c:string,p:string,refusal:boolean>>, ord int")
    labels = spark.createDataFrame([("l", 14.0)], "id string, serving_g double")
    rows, unread = read_plan.food_map(inputs, readings, "b", labels)
    got = {r.id: (r.kind, r.fdcId, r.estimate, r.grams, r.grams_basis, r.reason) for r in rows.collect()}
    assert got == {
        "a": ("usda-single-food", 1, False, 453.6, "package", None), "p": ("usda-mixed-dish-estimate", 3, True, 226.0, "estimated portion: 1 cup", None),
        "n": ("unmapped", None, None, None, None, "no candidate shares a word with the item"), "l": ("label", None, False, 14.0, "label serving", None)}
    assert [r.id for r in unread.collect()] == ["u"]


@pytest.mark.parametrize("rows, want", [([("2026-09-23T03:00:00Z",)], "2026-09-22"), ([("2026-09-23T20:00:00Z",)], "2026-09-23")])
def test_local_date_of_a_pull(spark, rows, want):
    from larderline.operators.items import local_date
    df = spark.createDataFrame(rows, "t string")
    assert str(df.select(local_date(F.col("t"), "America/Los_Angeles").alias("d")).first().d) == want
