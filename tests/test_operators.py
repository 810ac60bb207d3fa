"""Joins and selections against brute force, with hot keys."""

import math
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from larderline.config import FoodRules, MatchRules, RiskRules
from larderline.operators.dedup import keep_distinct_places, numbered_chunks, place_key
from larderline.operators.items import median_price, with_ids
from larderline.operators.matching import _side, match, near_spellings
from larderline.operators.ordering import ordered_position, sum_before
from larderline.operators.retrieval import candidate_foods, retrieve
from larderline.plans import street_risk as risk


def metres(a, b, c, d):
    x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 6371000 * 2 * math.asin(math.sqrt(x))


@pytest.mark.parametrize("per_task", [5, 100, 10**6])
def test_ordered_position_with_a_hot_group(spark, per_task):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.randint(0, 40), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(7)
    got = {r.i: r.p for r in ordered_position(df, ["g"], ["v", "i"], "p", per_task).collect()}
    for g in {r[0] for r in rows}:
        for n, (_, i) in enumerate(sorted((v, i) for h, v, i in rows if h == g), 1):
            assert got[i] == n
    overall = {r.i: r.p for r in ordered_position(df, [], ["v", "i"], "p", per_task).collect()}
    assert overall == {i: n for n, (_, i) in enumerate(sorted((v, i) for _, v, i in rows), 1)}


@pytest.mark.parametrize("per_task", [5, 10**6])
def test_sums_of_all_rows_before(spark, per_task):
    rng = random.Random(3)
    rows = [(i // 3, i, rng.choice([None, 0, 1, 7])) for i in range(400)]
    df = spark.createDataFrame(rows, "v int, i int, n long").repartition(5)
    out = sum_before(df, ["v", "i"], "n", "s", per_task)
    assert {r.i: r.s for r in out.collect()} == {i: sum(n or 0 for _, j, n in rows if j < i) for _, i, _ in rows}
    assert sum_before(df.limit(0), ["v", "i"], "n", "s").collect() == []


@pytest.mark.parametrize("base", [(37.7, -122.4), (64.0, 179.9995), (-0.0003, 10.0)])
@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_greedy_duplicates_whatever_the_rounds(spark, base, rounds):
    rng = random.Random(11)
    rows = [(i, rng.choice("hhhab"), base[0] + rng.uniform(0, .006), (base[1] + rng.uniform(0, .012) + 180) % 360 - 180) for i in range(500)]
    rows += [(1000 + i, "h", rows[0][2], rows[0][3]) for i in range(300)]  # a third of all rows at one point
    want, seen = set(), {}
    for i, n, lat, lon in sorted(rows):
        prior = seen.setdefault(n, [])
        if not any(metres(lat, lon, a, b) <= 150 for a, b in prior):
            want.add((i, not prior))
            prior.append((lat, lon))
    df = spark.createDataFrame(rows, "i int, name string, lat double, lon double").repartition(5)
    got = keep_distinct_places(df, F.col("name"), "i", 150.0, rounds).collect()
    assert {(r.i, r.first_of_name) for r in got} == want


def test_greedy_duplicates_in_a_long_chain(spark):
    """10,000 neighbours of one name in order, around the globe: every other one stays, and the jobs are as many as for a short chain."""
    side = lambda n: spark.createDataFrame([(i, "h", 10.0, (i * 0.001 + 175) % 360 - 180) for i in range(n)], "i int, name string, lat double, lon double")
    status = spark.sparkContext.statusTracker()

    def jobs(n):
        spark.sparkContext.setJobGroup(f"chain {n}", "")
        kept = [r.i for r in keep_distinct_places(side(n), F.col("name"), "i", 150.0).collect()]
        spark.sparkContext.setJobGroup("", "")
        assert sorted(kept) == list(range(0, n, 2))
        return len(status.getJobIdsForGroup(f"chain {n}"))

    assert jobs(10_000) <= jobs(100) + 12


def test_place_key(spark):
    df = spark.createDataFrame([("A", "1 B St", 1.0, 2.0, True), ("A", "1 B St", 1.0, 2.0, False), ("A", None, 37.123456, -122.5, False)],
                               "n string, a string, lat double, lon double, f boolean")
    keys = [r.k for r in df.select(place_key(F.col("n"), F.col("a"), F.col("lat"), F.col("lon"), F.col("f")).alias("k")).collect()]
    assert keys == ["A", "A (1 B St)", "A (37.12346,-122.50000)"]


def test_street_risk_against_all_pairs_with_a_hot_cell(spark):
    rng = random.Random(4)
    dense = lambda: (37.75 + rng.uniform(0, .002), -122.45 + rng.uniform(0, .002))
    spread = lambda: (37.70 + rng.uniform(0, .05), -122.50 + rng.uniform(0, .05))
    places = [(f"p{i}", *(dense() if i % 2 else spread())) for i in range(60)] + [("far", 38.5, -121.0)]
    cats = ["Assault", "Burglary", "Drug Offense", "Other", None]
    rows = []
    for i in range(900):
        at = dense() if i % 3 == 0 else spread()
        for j in range(rng.randint(1, 3)):
            rows.append((len(rows), i if i % 10 else None, rng.choice(cats), str(at[0] + j * 1e-3), str(at[1])))
    rows.append((len(rows), 5, "Assault", "not a number", "x"))
    p = spark.createDataFrame(places, "key string, lat double, lon double").withColumn("category", F.lit("cafe"))
    r = spark.createDataFrame(rows, "row_id int, incident_id int, incident_category string, latitude string, longitude string").repartition(6)
    rules = RiskRules()
    got = {x.key: x for x in risk.street_risk(p, r, rules).collect()}
    top = {}
    for x in risk.top_categories(p, r, rules).collect():
        top.setdefault(x.key, []).append((-x.n, x.category))
    inc = {}
    for row_id, iid, cat, lat, lon in rows[:-1]:
        inc.setdefault(str(row_id if iid is None else iid), [float(lat), float(lon), set()])[2].add(cat or "Unknown")
    want = {}
    for key, lat, lon in places:
        n, near, count, every = {b: 0 for b in rules.buckets}, None, {}, 0
        for a, b, cs in inc.values():
            if abs(a - lat) > .006 or abs(b - lon) > .0075:
                continue
            d = metres(lat, lon, a, b)
            near = d if near is None else min(near, d)
            if d > 150:
                continue
            every += 1
            for bucket, members in rules.buckets.items():
                n[bucket] += bool(cs & set(members))
            for c in cs:
                count[c] = count.get(c, 0) + 1
        want[key] = (n, every, near, sorted((-k, c) for c, k in count.items())[:5])
    totals = {k: sum(v[0].values()) for k, v in want.items()}
    order = sorted(want, key=lambda k: (-totals[k], -want[k][0]["violent"], k))
    for key, (n, every, near, cats5) in want.items():
        x = got[key]
        assert (x.violent, x.property, x.drug, x.all_incidents) == (n["violent"], n["property"], n["drug"], every)
        assert x.nearest_incident_m == (None if near is None else round(near))
        assert x.rank == order.index(key) + 1
        assert x.percentile == round(100 * sum(t < totals[key] for t in totals.values()) / (len(totals) - 1), 1)
        assert x.per_month == round(totals[key] / (365 / 30.4375), 2)
        assert sorted(top.get(key, [])) == cats5


def test_item_ids_do_not_depend_on_order_and_split_a_hot_name(spark):
    rows = [("Cafe", "menu", "S", "Soup", f"d{i:03}", "", float(i % 3) if i % 4 else None, "s", "2026-01-01", "ok", i) for i in range(90)]
    rows += [("Cafe", "menu", "S", "Soup-2", "", "", 1.0, "s", "2026-01-01", "ok", 500)]
    schema = ("place string, kind string, section string, name string, description string, size string, price double, source string, "
              "as_of string, status string, pos int")
    ids = lambda data, n: {(r.description, r.id) for r in with_ids(spark.createDataFrame(data, schema).repartition(3), n).collect()}
    plain = ids(rows, 10**6)
    assert plain == ids(rows[::-1], 10**6) == ids(rows, 10)
    assert ("d000", "cafe--soup") in plain and ("d001", "cafe--soup-2") in plain and ("", "cafe--soup-2") in plain  # the collision is kept for the check


def test_median_with_a_hot_place(spark):
    rng = random.Random(6)
    rows = [("h" if i % 3 else f"p{i % 5}", rng.choice([None, rng.randint(1, 50) / 2]), i) for i in range(800)]
    got = {r.p: r.median_price for r in median_price(spark.createDataFrame(rows, "p string, v double, i int"), "p", "v", "i", 50).collect()}
    for p in {r[0] for r in rows}:
        vs = sorted(v for q, v, _ in rows if q == p and v is not None)
        assert got[p] == (vs[(len(vs) - 1) // 2] + vs[len(vs) // 2]) / 2


def test_request_chunks(spark):
    rows = {r.i: r.request for r in numbered_chunks(spark.createDataFrame([(i,) for i in range(45)] * 2, "i int"), "i", 20).collect()}
    assert rows[0] == 0 and rows[19] == 0 and rows[20] == 1 and rows[44] == 2 and len(rows) == 45


@pytest.mark.parametrize("common_df", [10**6, 12, 0])
def test_retrieval_is_the_same_whatever_counts_as_common(spark, common_df):
    rng = random.Random(9)
    vocab = [f"{a}{b}" for a in ("chick", "tomat", "rice", "bread", "salm") for b in ("en", "o", "ly", "ing", "ads")] + ["raw", "oil", "pie"]
    foods = [(i, "Survey (FNDDS)" if i % 3 == 0 else "SR Legacy", "Fast Foods" if i % 10 == 1 else "c",
              " ".join(["raw"] * (i % 3 > 0) + rng.choices(vocab, k=4))) for i in range(120)]
    items = [(f"i{i}", rng.choice(["", "Prawn"]), " ".join(rng.choices(vocab, k=2)), rng.choice(["", "raw oil"])) for i in range(25)]
    items += [("only-common", "", "raw", ""), ("none", "", "zz 12", "")] + [(f"same{i}", "", "raw pie", "") for i in range(40)]
    f = candidate_foods(spark.createDataFrame(foods, "fdcId int, dataType string, category string, description string"))
    q = spark.createDataFrame(items, "id string, section string, name string, description string")
    rules = replace(FoodRules(), common_df=common_df)
    got = {}
    for r in retrieve(q, f, rules).collect():
        got.setdefault((r.id, r.pool), []).append((r.rank, r.fdcId, r.score))

    def stems(text):
        import re
        out = set()
        for t in re.findall("[a-z]+", text.lower()):
            if len(t) > 2:
                out.add(t[:-2] if len(t) > 4 and t.endswith("es") and not t.endswith("ses") else t[:-1] if len(t) > 3 and t.endswith("s") and not t.endswith("ss") else t)
                if len(t) >= 5:
                    out.add("~" + t[:5])
        return out

    kept = [x for x in foods if x[1].startswith("Survey") or x[2] != "Fast Foods"]
    df = {}
    for x in kept:
        for t in stems(x[3]):
            df[t] = df.get(t, 0) + 1
    for iid, section, name, desc in items:
        weights = {}
        for text, w in ((name, 1.0), (desc, 0.5), (section, 0.25)):
            text += " " + " ".join(rules.aliases.get(t, "") for t in stems(text))
            for t in stems(text):
                weights[t] = max(weights.get(t, 0), w * (0.5 if t.startswith("~") else 1))
        for pool in ("single", "dish"):
            scored = []
            for x in kept:
                if x[1].startswith("Survey") != (pool == "dish"):
                    continue
                shared = sorted(stems(x[3]) & set(weights))
                if shared:
                    scored.append((-round(sum(weights[t] * math.log(len(kept) / df[t]) for t in shared), 9), x[0]))
            want = [(n, fid, -s) for n, (s, fid) in enumerate(sorted(scored)[:8], 1)]
            have = sorted(got.get((iid, pool), []))
            assert [h[:2] for h in have] == [w[:2] for w in want], (iid, pool)
            assert all(math.isclose(h[2], w[2], abs_tol=1e-8) for h, w in zip(have, want))


@pytest.mark.parametrize("at_once", [(3, 5), (1024, 2048)])
def test_the_closest_foods_of_a_task_are_those_of_all_pairs(monkeypatch, at_once):
    """Scores by blocks of items and foods; ids on several rows or null, equal scores, and shares of zero."""
    import pyarrow as pa
    from larderline.operators import retrieval
    monkeypatch.setattr(retrieval, "ITEMS_AT_ONCE", at_once[0])
    monkeypatch.setattr(retrieval, "FOODS_AT_ONCE", at_once[1])
    rng = random.Random(8)
    vocab = [f"w{k}" for k in range(12)]
    share = {t: rng.choice([0.0, 0.5, rng.random()]) for t in vocab}
    items = [(f"q{k}", sorted(rng.sample(vocab, rng.randint(1, 4)))) for k in range(7)]
    foods = sorted([(rng.choice([-1, *range(20)]), rng.choice(["dish", "single"]), rng.sample([*vocab, "x"], rng.randint(0, 5))) for _ in range(40)], key=lambda x: x[:2])
    rows = [(q, [share[t] for t in ts], None, None, " ".join(ts)) for q, ts in items]
    rows += [(None, None, None if i < 0 else i, pool, " ".join(ts)) for i, pool, ts in foods]
    types = [("q", pa.string()), ("s", pa.list_(pa.float64())), ("fdcId", pa.int64()), ("pool", pa.string()), ("words", pa.string())]
    table = pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)], [n for n, _ in types])
    found = [r for b in retrieval._closest(2)(table.to_batches(max_chunksize=9)) for r in b.to_pylist()]
    for q, ts in items:
        for pool in ("dish", "single"):
            all_words = {i: sorted(t for j, p, words in foods if (j, p) == (i, pool) for t in words if t in ts) for i, p, _ in foods if p == pool}
            want = sorted((-round(sum(share[t] for t in words), 9), i) for i, words in all_words.items() if words)[:2]
            got = sorted((-round(r["score"], 9), -1 if r["fdcId"] is None else r["fdcId"]) for r in found if (r["q"], r["pool"]) == (q, pool))[:2]
            assert [x for _, x in got] == [x for _, x in want] and all(math.isclose(a[0], b[0], abs_tol=1e-9) for a, b in zip(got, want)), (q, pool)


def test_billionths_are_rounded_as_spark_rounds(spark):
    import numpy as np
    from larderline.operators.retrieval import _nine_decimals
    rng = random.Random(1)
    values = [0.0, 1.0000000005, 0.0000000015, 123.4567891235, 17.0000000025] + [round(rng.random() * 100, 10) for _ in range(500)]
    want = [r.v for r in spark.createDataFrame([(v,) for v in values], "x double").select(F.round("x", 9).alias("v")).collect()]
    assert [round(n) for n in _nine_decimals(np.array(values)).tolist()] == [round(w * 1e9) for w in want]


def test_retrieval_moves_the_best_of_each_task_and_no_pairs(spark, monkeypatch):
    """400 foods that all share a word with 20 items; an id on two rows is one food, with its words counted twice."""
    from larderline.operators import retrieval
    seen, first = [], retrieval.first_rows
    monkeypatch.setattr(retrieval, "first_rows", lambda df, *a: (seen.append(df.count()), first(df, *a))[1])
    foods = spark.createDataFrame([(i, "dish", f"raw oil{'x' * (i % 7)}") for i in range(400)] + [(7, "dish", "raw"), (None, "dish", "salt")],
                                  "fdcId long, pool string, description string")
    items = spark.createDataFrame([(i, "", "raw" + " pie" * (i % 2) + " salt" * (i == 3) + f" i{'y' * i}", "") for i in range(20)], "id long, section string, name string, description string")
    got = {(r.id, r["rank"]): (r.fdcId, round(r.score, 6)) for r in retrieval.retrieve(items, foods).collect()}
    raw = math.log(402 / 401)
    assert all(got[i, n] == (n - 2, round(raw, 6)) for i in range(20) if i != 3 for n in range(2, 9))
    assert all(got[i, 1] == (7, round(2 * raw, 6)) for i in range(20) if i != 3)
    assert got[3, 1] == (None, round(math.log(402), 6)) and got[3, 2] == (7, round(2 * raw, 6))
    assert sum(seen) <= 20 * 8 * int(spark.conf.get("spark.sql.shuffle.partitions")) < 20 * 400


PLACE = "key string, name string, addr string, lat double, lon double"
BIZ = "dataset string, business_id string, name string, address string, postal string, lat double, lon double"


@pytest.mark.parametrize("place, biz, want", [
    (("Golden Lantern", "700 Grant Avenue", 37.7946, -122.4058), ("GOLDEN LANTERN RESTAURANT", "700 GRANT AVE", "94108", None, None), "name+address"),
    (("Golden Lantern", "", 37.7946, -122.4058), ("Golden Lantern", "", "94108", 37.7947, -122.4059), "name-only"),
    (("Golden Lantern", "", 37.7946, -122.4058), ("Golden Lantern", "", "94122", 37.76, -122.48), "none"),
    (("Golden Lantern", "", 37.7946, -122.4058), ("Golden Lantern", "", "94133", None, None), "name-only"),
    (("Golden Lantern", "", 37.7946, -122.4058), ("Golden Lantern", "", "94999", None, None), "none"),
    (("Golden Lantern", "1 Bay St", 37.7946, -122.4058), ("GOLDEN  LANTERNS", "9 Bay St", "", 37.7947, -122.4058), "name-only"),
    (("Golden Lantern", "1 Bay St", 37.7946, -122.4058), ("Golden Lantern", "9 Bay St", "", None, None), "none"),
    (("Wheat Field", "", 37.7946, -122.4058), ("Wheatfield", "", "", 37.7960, -122.4060), "name-only"),
    (("Golden Lantern Noodles", "", 37.7946, -122.4058), ("Golden Lantern", "", "", 37.7947, -122.4059), "name-only"),
    (("Golden Lantern Noodles", "", 37.7946, -122.4058), ("Golden Lantern", "", "", 37.7970, -122.4059), "none"),
    (("Reveille Coffee", "", 37.7946, -122.4058), ("Reveile Coffee", "", "", 37.7947, -122.4059), "name-only"),
    (("Reveille Coffee", "5 Elm", 37.7946, -122.4058), ("Reveilles Cofee", "5 Elm St", "", None, None), "name+address"),
    (("Fisherman Crab Shack", "5 Elm", 37.7946, -122.4058), ("Crab Shack Wharf Side", "5 Elm St", "", None, None), "name+address"),
    (("Golden", "5 Elm", 37.7946, -122.4058), ("The Cafe", "5 Elm St", "", None, None), "name+address"),
    (("The Cafe", "5 Elm", 37.7946, -122.4058), ("The Cafe", "5 Elm St", "", None, None), "none"),
    (("Golden Lantern", "", 0.0, -122.4058), ("Golden Lantern", "", "94133", 37.0, -122.0), "name-only"),
])
def test_entity_match_cases(spark, place, biz, want):
    p = spark.createDataFrame([("k", *place)], PLACE)
    b = spark.createDataFrame([("d", "1", *biz)], BIZ)
    assert match(p, b).places.first().confidence == want


def test_match_keeps_nearest_address_and_siblings(spark):
    p = spark.createDataFrame([("k", "Golden Lantern", "", 37.7946, -122.4058)], PLACE)
    b = spark.createDataFrame([
        ("a", "1", "Golden Lantern", "1 Elm St", "", 37.7947, -122.4058), ("a", "2", "Golden Lantern", "9 Oak St", "", 37.7970, -122.4058),
        ("b", "3", "GOLDEN LANTERN", "1 ELM STREET", "94999", None, None), ("b", "4", "Golden", "1 Elm St", "", 37.7947, -122.4058)], BIZ)
    out = match(p, b, MatchRules())
    assert {(r.business_id, r.kind) for r in out.matches.collect()} == {("1", "exact"), ("3", "sibling")}
    assert [r.other_address for r in out.other_addresses.collect()] == ["9 OAK ST"]
    assert out.places.first().methods == ["exact", "sibling"]


def test_far_businesses_with_two_shared_words_are_rejected(spark):
    p = spark.createDataFrame([("k", "Golden Lantern House", "", 37.7946, -122.4058)], PLACE)
    b = spark.createDataFrame([("d", str(k), "Golden Lantern Noodles", f"{k} Far St", "94999", None, None) for k in range(5)], BIZ)
    got = match(p, b).rejected.collect()
    assert sorted(r.business_id for r in got) == list("01234") and {(r.kind, r.reason) for r in got} == {("overlap", "conflict")}


@pytest.mark.parametrize("blocks", [(256, 8), (2, 2)])
def test_rejected_are_the_first_of_all_that_share_a_word(spark, blocks):
    """Against all pairs, with a word and a name on a third of the registrations."""
    import difflib
    rng = random.Random(8)
    words = ["golden", "lantern", "noodles", "noodels", "pizza", "house", "north", "beach", "crab", "shack", "thai", "coffee", "cofee"]
    name = lambda: " ".join(["north"] * (rng.random() < 0.4) + rng.sample(words, rng.randint(1, 4)))
    at = lambda: (37.79 + rng.randrange(8) / 1500, -122.4) if rng.random() < 0.7 else (None, None)
    street = lambda: rng.choice(["", "1 Elm St", "2 Elm St", "1 Oak St"])
    places = [(f"k{i}", name(), street(), *at()) for i in range(40)]
    regs = [("ab"[i % 2], f"{i:03}", "Golden Lantern" if i % 3 == 0 else name(), street(), rng.choice(["94133", "94999", ""]), *at()) for i in range(90)]
    rules = replace(MatchRules(), first_block=blocks[0], block_growth=blocks[1])
    p, b = spark.createDataFrame(places, PLACE), spark.createDataFrame(regs, BIZ)
    out = match(p, b, rules)
    got = {}
    for r in out.rejected.collect():
        got.setdefault(r.key, []).append((r.dataset, r.business_id, r.kind, r.reason))
    ps = _side(p, "p_", "name", "addr", rules).collect()
    bs = sorted(_side(b, "b_", "name", "address", rules).collect(), key=lambda r: (r.dataset, r.business_id))

    def metres(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371000 * math.asin(math.sqrt(h))

    df = {}
    for y in bs:
        for t in y.b_set:
            df[t] = df.get(t, 0) + 1
    for x in ps:
        want = []
        for y in bs:
            s, t, area = set(x.p_set), set(y.b_set), set(rules.place_words)
            same_street = x.p_street is not None and x.p_street == y.b_street
            if not (s | {x.p_joined}) & (t | {y.b_joined}) and not same_street:
                continue
            ratio = difflib.SequenceMatcher(None, x.p_joined, y.b_joined).ratio()
            kind = ("exact" if s == t else "compact" if x.p_joined == y.b_joined else "subset" if s <= t or t <= s else "overlap" if len((s & t) - area) >= 2
                    else "fuzzy" if ratio >= rules.fuzzy_ratio else None)
            if kind is None or same_street:
                continue
            strong = kind in ("exact", "compact") or kind == "fuzzy" and ratio >= rules.fuzzy_strong
            if x.p_lat and y.b_lat:
                d = metres(x.p_lat, x.p_lon, y.b_lat, y.b_lon)
                geo = "same" if d <= 120 else "near" if d <= 400 else "conflict" if d > 1000 else "far"
            else:
                geo = None if y.postal == "" else "zip" if y.postal in rules.area_zips else "conflict"
            smaller = (s if s <= t else t) - area
            best = min((df.get(w, 10**9) for w in smaller), default=10**9)
            if x.p_street and y.b_street:
                ok, geo_or_note = strong and geo == "same", "addr-conflict"
            else:
                geo_or_note = geo
                ok = geo not in ("conflict", "far") and (kind in ("exact", "compact") or kind == "fuzzy" and strong and geo == "same" or kind == "subset" and (
                    geo == "same" and (best <= rules.df_distinct or len(smaller) >= rules.min_identity) or geo == "zip" and best <= rules.df_unique))
            if not ok:
                want.append((y.dataset, y.business_id, kind, geo_or_note))
        assert sorted(got.get(x.key, [])) == want[:6], x.key


def test_a_frequent_word_gives_a_prefix_of_the_rejected(spark, monkeypatch):
    from larderline.operators import matching
    seen = []
    decide = matching._decide
    monkeypatch.setattr(matching, "_decide", lambda pairs, rules: (seen.append(pairs.count()), decide(pairs, rules))[1])
    p = spark.createDataFrame([(f"k{i}", f"Golden Lantern number{i}", "", 37.79, -122.4) for i in range(50)], PLACE)
    b = spark.createDataFrame([("d", f"{i:05}", f"Golden Lantern far{i}", "", "94999", None, None) for i in range(4000)], BIZ)
    out = match(p, b, replace(MatchRules(), first_block=16))
    seen.clear()
    assert out.rejected.count() == 50 * 6 and sum(seen) == 50 * 16


def test_other_names_at_an_address_and_equal_rows_form_no_pairs(spark, monkeypatch):
    """150 names at one address, each the name of a place and of a registration; and 40 equal places beside 40 equal registrations."""
    from larderline.operators import matching
    seen, rated = [], matching._rated
    monkeypatch.setattr(matching, "_rated", lambda pairs, near: (seen.append(pairs.count()), rated(pairs, near))[1])
    rng = random.Random(3)
    names = ["".join(rng.choices("bcdfghklmnpqrt", k=9)) for _ in range(150)]
    at, far = ("5 Elm St", 37.79, -122.4), ("", 37.70, -122.4)
    p = spark.createDataFrame([(f"k{i}", n, *at) for i, n in enumerate(names)] + [(f"e{i}", "Golden Lantern", *far) for i in range(40)], PLACE)
    b = spark.createDataFrame([("d", f"{i:03}", n, at[0], "94133", None, None) for i, n in enumerate(names)]
                              + [("d", f"e{i:03}", "Golden Lantern", "", "94133", far[1], far[2]) for i in range(40)], BIZ)
    out = match(p, b)
    got = {r.key: (r.confidence, r.methods, r.registrations) for r in out.places.collect()}
    assert got == {f"k{i}": ("name+address", ["exact"], 1) for i in range(150)} | {f"e{i}": ("name-only", ["exact"], 40) for i in range(40)}
    pairs = Counter(r.key for r in out.matches.collect())
    assert pairs == Counter({f"k{i}": 1 for i in range(150)} | {f"e{i}": 40 for i in range(40)})
    assert sum(seen) < 400


def test_a_pair_is_judged_once_when_accepted_pairs_are_asked_for(spark):
    """The distance and the words that two names share are worked out once, however many filters ask for them."""
    from larderline.operators.matching import _decide
    pairs = spark.createDataFrame([], "pc int, p_set array<string>, b_set array<string>, p_joined string, b_joined string, p_street string, b_street string, "
                                  "p_located boolean, b_located boolean, p_lat double, p_lon double, b_lat double, b_lon double, postal string, p_best long, b_best long, ratio double")
    accepted = _decide(pairs.repartition(2), MatchRules()).filter(F.col("confidence").isNotNull()).select("pc", "kind", "confidence", "d")
    plan = accepted._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("asin(") == 1 and plan.count("array_intersect(") == 1


def test_repeated_and_missing_ids_of_a_match(spark):
    """A key or an id on several rows counts each of them; rows without an id are siblings only."""
    place, other = ("Golden Lantern", "", 37.79, -122.4), ("Crab Shack", "", 37.79, -122.4)
    p = spark.createDataFrame([("a", *place), ("a", *place), ("b", *place), ("b", *other), (None, *place)], PLACE)
    golden, crab = ("Golden Lantern", "1 Elm St", "", 37.79, -122.4), ("Crab Shack", "1 Elm St", "", 37.79, -122.4)
    b = spark.createDataFrame([("d", "1", *golden), ("d", "1", *golden), ("d", "2", *golden), ("d", "2", *crab), ("d", None, *golden), ("d", None, *golden)], BIZ)
    out = match(p, b)
    got = Counter((r.key, r.business_id, r.kind) for r in out.matches.collect())
    assert got == {("a", "1", "exact"): 4, ("a", "2", "exact"): 2, ("a", None, "sibling"): 4,
                   ("b", "1", "exact"): 2, ("b", "2", "exact"): 2, ("b", None, "sibling"): 2}
    assert sorted((r.key or "", r.confidence, r.registrations) for r in out.places.collect()) == [
        ("", "none", 0), ("a", "name-only", 10), ("a", "name-only", 10), ("b", "name-only", 6), ("b", "name-only", 6)]


@pytest.mark.parametrize("ratio", [0.85, 0.7])
def test_near_spellings_are_those_of_all_pairs(spark, ratio):
    import difflib
    rng = random.Random(5)
    base = ["".join(rng.choices("abcdefg", k=rng.randint(1, 14))) for _ in range(60)]

    def changed(t):
        t = list(t)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(t) + 1)
            t[k:k + rng.randint(0, 1)] = rng.choice(["", "x", "a"])
        return "".join(t)

    left, right = base + [None, ""], [changed(rng.choice(base)) for _ in range(150)] + [None, "", base[0]]
    got = near_spellings(spark.createDataFrame([(x,) for x in left], "l string"), spark.createDataFrame([(x,) for x in right], "r string"), ratio).collect()
    want = {(x, y): r for x in set(left) - {None, ""} for y in set(right) - {None, ""} if x != y and (r := difflib.SequenceMatcher(None, x, y).ratio()) >= ratio}
    assert len(got) == len(want) and all(abs(want[r.l, r.r] - r.ratio) < 1e-12 for r in got)


def test_radius_reaches_a_wide_box(spark):
    """Counts and nearest distances for three boxes and radii against all pairs."""
    import math
    import random
    rng = random.Random(4)
    sites = [(37.7 + rng.random() / 10, -122.5 + rng.random() / 10) for _ in range(25)] + [(37.7, -122.5)]
    points = [(37.7 + rng.random() / 10, -122.5 + rng.random() / 10) for _ in range(1500)]

    def metres(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371000 * math.asin(math.sqrt(h))

    from larderline.operators.spatial import radius_by_category, radius_summary
    s = spark.createDataFrame(sites, "lat double, lon double")
    p = spark.createDataFrame([(*x, 1, "abc"[k % 3]) for k, x in enumerate(points)], "lat double, lon double, n long, kind string")
    for radius, box in ((150, (0.006, 0.0075)), (2000, (0.03, 0.03)), (9000, (0.2, 0.2))):
        near = {x: [(metres(*x, *y), k) for k, y in enumerate(points) if abs(y[0] - x[0]) <= box[0] and abs(y[1] - x[1]) <= box[1]] for x in sites}
        got = {(r["lat"], r["lon"]): r for r in radius_summary(s, p, ["n"], radius, box).collect()}
        for x in sites:
            want = [d for d, _ in near[x] if d <= radius]
            assert (got[x]["n"] if x in got else 0) == len(want)
            if near[x]:
                assert abs(got[x]["nearest_m"] - min(near[x])[0]) < 1e-6
        kinds = {(r["lat"], r["lon"], r["kind"]): r["n"] for r in radius_by_category(s, p, "kind", "n", radius, box).collect()}
        assert kinds == {(*x, "abc"[j]): n for x in sites for j in range(3) if (n := sum(d <= radius and k % 3 == j for d, k in near[x]))}


def test_a_crowded_tile_is_split(spark):
    """100,000 distinct points in one fine tile: the sums are exact, and few points are opened."""
    from larderline.operators import spatial
    rng = random.Random(2)
    box, radius = (0.006, 0.0075), 20.0
    side = spatial.cell_of(box)[0] / spatial.FINE, spatial.cell_of(box)[1] / spatial.FINE
    corner = math.floor(37.75 / side[0]) * side[0], math.floor(-122.45 / side[1]) * side[1]
    at = lambda: (corner[0] + rng.random() * side[0] * 0.999, corner[1] + rng.random() * side[1] * 0.999)
    points = [(*at(), 1, "abc"[k % 3]) for k in range(100_000)]
    sites = [at() for _ in range(3)] + [(corner[0] + 0.002, corner[1])]
    s = spark.createDataFrame(sites, "lat double, lon double")
    p = spark.createDataFrame(points, "lat double, lon double, n long, kind string").repartition(8).cache()
    near = {x: [(metres(*x, *y[:2]), y[3]) for y in points] for x in sites}
    got = {(r["lat"], r["lon"]): r for r in spatial.radius_summary(s, p, ["n"], radius, box).collect()}
    for x in sites:
        assert got[x]["n"] == sum(d <= radius for d, _ in near[x])
        assert math.isclose(got[x]["nearest_m"], min(near[x])[0], abs_tol=1e-6)
    kinds = {(r["lat"], r["lon"], r["kind"]): r["n"] for r in spatial.radius_by_category(s, p, "kind", "n", radius, box).collect()}
    assert kinds == {(*x, j): n for x in sites for j in "abc" if (n := sum(d <= radius and k == j for d, k in near[x]))}
    tiled = spatial.with_tiles(p, spatial.cell_of(box))
    opened = sum(pairs.filter("opened").join(tiled, [f"y{k}", f"x{k}"]).count() for k, pairs in enumerate(spatial._levels(s, tiled, radius, box, spatial.cell_of(box), ["n"], True)))
    assert opened < 0.1 * len(points) * len(sites)


def test_long_votes_follow_the_rule_of_samples(spark):
    """The sums over a long table answer as the expression over samples does."""
    import random
    from larderline.operators import votes as V
    rng = random.Random(6)
    rows = [(k, n, rng.choice("ynux"), [rng.choice(["hot", "Hot", "cold ", "", "far"]) for _ in range(rng.randint(0, 2))], "Hot and cold") for k in range(60) for n in range(rng.randint(1, 7))]
    long = spark.createDataFrame(rows, "key long, ord int, code string, words array<string>, text string")
    listed = long.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("ord", "code", "words"))).alias("s"), F.first("text").alias("text"))
    one = listed.select("key", V.route_answer(F.col("s"), F.col("text"), 2, 2).alias("r")).select("key", "r.*")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, V.route_votes(long, "key", 2, 2).collect()))
    rows = [(k, n, rng.choice(["c1", "c2", "c9", "none", "refused", None]), rng.choice(["p1", "p2", "none", None])) for k in range(80) for n in range(rng.randint(1, 6))]
    long = spark.createDataFrame(rows, "key long, ord int, c string, p string")
    listed = long.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("ord", "c", "p"))).alias("s"))
    one = listed.select("key", V.route_choice(F.col("s"), F.lit(3), 2, 2).alias("r")).select("key", "r.*")
    assert sorted(map(repr, one.collect())) == sorted(map(repr, V.route_choices(long, "key", F.lit(3), 2, 2).select(*one.columns).collect()))


def test_pairs_of_many_ids_are_spelled_out_from_lists(spark, monkeypatch):
    """Lists of a few ids, names at an address and names without, ids that come twice; no join has a row for each pair."""
    from larderline.operators import matching
    monkeypatch.setattr(matching, "IDS_HELD", 3)
    at, off = ("Golden Lantern", "5 Elm St"), ("Crab Shack", "")
    p = spark.createDataFrame([(f"k{i:02}", *(at if i % 2 else off), 37.79, -122.4) for i in range(40)] * 2, PLACE)
    b = spark.createDataFrame([("d", f"{i:02}", *(at if i % 2 else off), "94133", 37.79, -122.4) for i in range(60)] + [("d", "01", *at, "94133", 37.79, -122.4)], BIZ)
    out = match(p, b).matches
    got = Counter((r.key, r.business_id, r.kind, r.confidence, r.addr_note) for r in out.collect())
    assert got == {(f"k{i:02}", f"{j:02}", "exact", *(("name+address", "match") if i % 2 else ("name-only", None))): 4 if j == 1 else 2
                   for i in range(40) for j in range(60) if i % 2 == j % 2}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    top = plan[:plan.index("Join")]
    assert top.count("Generate") >= 2 and "inline" in top.lower()   # the ids come out of their lists above all joins


def test_names_spelled_alike_meet_at_an_address_or_near_place_only(spark):
    """120 numbers that differ in one digit, each at an address of its own, far from each other; registrations of one more digit beside them."""
    number = lambda i: f"12{i // 10:02}{i % 10}77"
    p = spark.createDataFrame([(f"k{i:03}", number(i), f"{i + 1} Elm St", 37.0 + i / 20, -122.4) for i in range(120)], PLACE)
    b = spark.createDataFrame([("d", f"a{i:03}", number(i)[:-1] + "8", f"{i + 1} Elm St", "94999", None, None) for i in range(0, 120, 2)]
                              + [("d", f"n{i:03}", number(i) + "5", "", "94999", 37.0 + i / 20 + 0.0005, -122.4) for i in range(1, 120, 2)], BIZ)
    out = match(p, b)
    assert {(r.l, r.r) for r in out.near.select("l", "r").collect()} == (
        {(number(i), number(i)[:-1] + "8") for i in range(0, 120, 2)} | {(number(i), number(i) + "5") for i in range(1, 120, 2)})
    assert sorted((r.key, r.business_id, r.kind) for r in out.matches.collect()) == [(f"k{i:03}", f"a{i:03}", "fuzzy") for i in range(0, 120, 2)]


@pytest.mark.parametrize("few", [0, 2, 50])
def test_near_spellings_at_one_of_few_or_many_places(spark, monkeypatch, few):
    import difflib
    from larderline.operators import matching
    monkeypatch.setattr(matching, "FEW_AREAS", few)
    rng = random.Random(6)
    texts = ["".join(rng.choices("abc", k=rng.randint(5, 9))) for _ in range(40)]
    side = lambda: [(t, a) for t in texts for a in rng.sample(range(30), rng.choice([1, 2, 9]))] + [("abcab", None), (None, 3)]
    left, right = side(), side()
    got = near_spellings(spark.createDataFrame(left, "l string, at long"), spark.createDataFrame(right, "r string, at long"), 0.85).collect()
    met = {(x, y) for x, a in left for y, b in right if x and y and a is not None and a == b and x != y}
    alike = lambda x, y: difflib.SequenceMatcher(None, x, y).ratio()
    found = {(r.l, r.r): r.ratio for r in got}
    assert {(x, y) for x, y in met if alike(x, y) >= 0.85} <= set(found) and len(found) == len(got)
    assert all(abs(alike(x, y) - r) < 1e-12 and r >= 0.85 for (x, y), r in found.items())
    if few == 50:
        assert set(found) <= met


