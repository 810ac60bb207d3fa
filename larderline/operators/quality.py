"""Data-quality rules; each returns (rule, severity, key, detail) and passes when empty."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.config import (DocumentRules, FoodRules, FreshnessRules, NutrientRules, VerdictRules, VoteRules)
from larderline.functions.numbers import printed_tolerance
from larderline.functions.text import item_text, strip, text_hash
from larderline.operators.dedup import duplicates
from larderline.operators.ordering import each
from larderline.operators.retrieval import record_kind
from larderline.session import spread


def problems(df: DataFrame, rule: str, key: Column, detail: Column, severity: str | Column = "fail") -> DataFrame:
    severity = F.lit(severity) if isinstance(severity, str) else severity
    return df.select(F.lit(rule).alias("rule"), severity.alias("severity"), key.cast("string").alias("key"),
                     detail.alias("detail"))


def union(parts: Iterable[DataFrame]) -> DataFrame:
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def only_in(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    other = right.select(F.col(right_key or key).alias("_k")).distinct()
    return left.select(key).distinct().join(other, F.col(key) == F.col("_k"), "left_anti")


def layer_keys(places: DataFrame, risk: DataFrame, inspections: DataFrame) -> DataFrame:
    """Every layer row belongs to exactly one place, and every place has a key, an area and a risk row."""
    keyed = places.filter(F.col("key").isNotNull())
    return union([
        problems(places.filter(F.col("key").isNull()), "place-without-key", F.col("name"), F.lit("no key")),
        problems(duplicates(keyed, ["key"]), "duplicate-key", F.col("key"),
                 F.concat(F.col("copies").cast("string"), F.lit(" places"))),
        problems(places.filter(F.coalesce("neighborhood", F.lit("")) == ""), "place-without-area", F.col("name"),
                 F.lit("no neighborhood")),
        problems(only_in(risk, keyed, "key"), "orphan-risk", F.col("key"), F.lit("matches no place")),
        problems(only_in(keyed, risk, "key"), "place-without-risk", F.col("key"), F.lit("no risk row")),
        problems(only_in(inspections, keyed, "key"), "orphan-inspection", F.col("key"), F.lit("matches no place")),
    ])


def document_shape(documents: DataFrame, keys: DataFrame, rules: DocumentRules = DocumentRules()) -> DataFrame:
    """Shape of menu and product documents, given as text in (file, doc).

    Read as text, because a typed read hides extra fields and a price written
    as text. Only the first malformed row of a file is reported.
    """
    field = lambda name: F.get_json_object("doc", f"$.{name}")
    is_product = F.array_contains(F.json_object_keys("doc"), "products")
    rows = F.from_json("doc", "items array<string>, products array<string>")
    d = (documents.withColumn("_product", is_product).withColumn("_r", rows)
         .withColumn("_rows", F.when(F.col("_product"), F.col("_r.products")).otherwise(F.col("_r.items")))
         .withColumn("name", field("name")).withColumn("status", field("status"))
         .withColumn("as_of", F.coalesce(field("as_of"), F.lit(""))))
    shape = F.when(F.col("_product"), F.array(*[F.lit(f) for f in sorted(rules.product_fields)])).otherwise(
        F.array(*[F.lit(f) for f in sorted(rules.item_fields)]))
    row = (d.select("file", "_product", shape.alias("_shape"), F.posexplode("_rows").alias("pos", "row"))
           .withColumn("_price", F.schema_of_variant(F.variant_get(F.try_parse_json("row"), "$.price", "variant")))
           .withColumn("_name", F.when(F.col("_product"), F.get_json_object("row", "$.name"))
                       .otherwise(F.get_json_object("row", "$.item"))))
    malformed = ((F.array_sort(F.json_object_keys("row")) != F.col("_shape"))
                 | (F.coalesce(strip(F.col("_name")), F.lit("-")) == "")
                 | ~F.col("_price").rlike("^(VOID|BIGINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN)$"))
    first = (row.filter(F.coalesce(malformed, F.lit(True))).groupBy("file")
             .agg(F.min(F.struct("pos", "row")).alias("m")))
    known = keys.select(F.col("key").alias("_k")).distinct()
    basis = (F.col("as_of") >= rules.basis_required_from) & (F.coalesce(F.size("_rows"), F.lit(0)) > 0)
    method = F.coalesce(field("extraction.method"), F.lit(""))
    has = lambda name: F.coalesce(field(f"extraction.{name}"), F.lit("")) != ""
    script = method == "script"
    return union([
        problems(d.join(known, F.col("name") == F.col("_k"), "left_anti"), "unknown-place", F.col("file"),
                 F.coalesce("name", F.lit(""))),
        problems(d.filter(~F.coalesce(F.col("status").isin(*rules.statuses), F.lit(False))), "status", F.col("file"),
                 F.coalesce("status", F.lit(""))),
        problems(first, "malformed-row", F.col("file"), F.substring("m.row", 1, 80)),
        problems(d.filter(basis & script & ~has("path")), "script-without-path", F.col("file"), F.col("as_of")),
        problems(d.filter(basis & ~script & ~(has("model") & has("prompt_hash"))), "no-extraction-basis",
                 F.col("file"), F.col("as_of")),
    ])


def same_rows(committed: DataFrame, derived: DataFrame, rule: str = "derived-equals") -> DataFrame:
    """Rows that differ between a stored table and its re-derivation, copies counted."""
    columns = committed.columns
    text = F.to_json(F.struct(*columns))
    return union([
        problems(committed.exceptAll(derived.select(*columns)), rule, F.lit("stored"), text),
        problems(derived.select(*columns).exceptAll(committed), rule, F.lit("derived"), text)])


def age_status(as_of: Column, today: str, max_age_days: int, warn_days: int) -> Column:
    """(status, due): the due day itself is still due-soon."""
    due, now = F.date_add(as_of, max_age_days), F.lit(today).cast("date")
    return F.struct(F.when(now > due, "stale").when(now >= F.date_sub(due, warn_days), "due-soon")
                    .when(due.isNotNull(), "current").alias("status"), due.alias("due"))


def freshness(documents: DataFrame, today: str, extensions: DataFrame | None = None,
              rules: FreshnessRules = FreshnessRules()) -> DataFrame:
    """Documents (slug, as_of, rows) past their kept age fail, inside the warning days warn.

    An extension (slug, until) still running turns stale into a warning;
    documents without rows are skipped.
    """
    d = documents.filter(F.col("rows") > 0).withColumn(
        "_a", age_status(F.col("as_of").try_cast("date"), today, rules.max_age_days, rules.warn_days))
    until = F.lit(None).cast("date")
    if extensions is not None:
        d = d.join(extensions.select("slug", F.col("until").try_cast("date").alias("until")), "slug", "left")
        until = F.col("until")
    held = (F.col("_a.status") == "stale") & F.coalesce(until >= F.lit(today).cast("date"), F.lit(False))
    status = F.when(held, "due-soon").otherwise(F.col("_a.status"))
    due = F.when(held, until).otherwise(F.col("_a.due"))
    d = d.withColumn("_s", F.when(status == "stale", "fail").when(status == "due-soon", "warn"))
    return problems(d.filter(F.col("_s").isNotNull()), "freshness", F.col("slug"),
                    F.concat(F.lit("due "), due.cast("string")), F.col("_s"))


def date_window(rows: DataFrame, rule: str, key: str, due: str, today: str, warn_days: int) -> DataFrame:
    """Past a due date fails, inside the warning days warns, no valid date fails."""
    day, now = F.col(due).try_cast("date"), F.lit(today).cast("date")
    severity = F.when(day.isNull() | (now > day), "fail").when(now >= F.date_sub(day, warn_days), "warn")
    detail = F.when(day.isNull(), "no valid date").when(now > day, F.concat(F.lit("past "), day.cast("string"))) \
        .otherwise(F.concat(F.lit("due "), day.cast("string")))
    d = rows.withColumn("_s", severity)
    return problems(d.filter(F.col("_s").isNotNull()), rule, F.col(key), detail, F.col("_s"))


def verdicts(entries: DataFrame, today: str, rules: VerdictRules = VerdictRules()) -> DataFrame:
    """Curated verdicts (name, verdict, verified): an allowed value with a date not past its review."""
    d = entries.filter(F.col("verdict").isNotNull())
    day, now = F.col("verified").try_cast("date"), F.lit(today).cast("date")
    due = F.date_add(day, rules.review_after_days)
    exempt = F.lit(None).cast("string")
    if rules.undated_until:
        exempt = F.create_map(*[F.lit(x) for kv in rules.undated_until.items() for x in kv])[F.col("name")]
    allowed = F.col("verdict").isin(*rules.verdicts)
    held = F.coalesce(exempt >= today, F.lit(False))
    severity = (F.when(~allowed, "fail").when(day.isNull(), F.when(held, "warn").otherwise("fail"))
                .when(now > due, "fail").when(now >= F.date_sub(due, rules.warn_days), "warn"))
    detail = (F.when(~allowed, F.concat(F.lit("verdict "), "verdict"))
              .when(day.isNull() & held, F.concat(F.lit("no date, exempt until "), exempt))
              .when(day.isNull(), "no date")
              .otherwise(F.concat(F.lit("review due "), due.cast("string"))))
    d = d.withColumn("_s", severity)
    return problems(d.filter(F.col("_s").isNotNull()), "verdict", F.col("name"), detail, F.col("_s"))


def undated_place_verdicts(places: DataFrame, today: str, rules: VerdictRules = VerdictRules()) -> DataFrame:
    """A verdict in the built index travels with its date."""
    exempt = [k.lower() for k, v in rules.undated_until.items() if today <= v]
    bad = places.filter((F.coalesce("verdict", F.lit("")) != "") & (F.coalesce("verified", F.lit("")) == ""))
    if exempt:
        bad = bad.filter(~F.lower("key").isin(*exempt))
    return problems(bad, "verdict-travels-dated", F.col("key"), F.lit("verdict without a dated ruling"))


def tags(tagged: DataFrame, untagged: DataFrame, items: DataFrame, rules: VoteRules = VoteRules()) -> DataFrame:
    """Long tags (id, text_hash, basis, attribute, answer, words) against the item table.

    Items carry ``basis``, the basis current for them.
    """
    text = item_text(F.col("section"), F.col("name"), F.col("description"))
    own = items.select("id", F.col("basis").alias("now_basis"), text.alias("text"))
    j = tagged.join(own, "id", "left")
    present = F.col("text").isNotNull()
    rows = (tagged.groupBy("id").agg(F.array_sort(F.collect_set("attribute")).alias("have"))
            .filter(F.col("have") != F.array(*[F.lit(a) for a in sorted(rules.attributes)])))
    low = F.lower("text")
    unquoted = (F.coalesce(F.size("words"), F.lit(0)) <= 0) | F.exists("words", lambda w: ~F.contains(low, F.lower(w)))
    listed = tagged.select("id").union(untagged.select("id"))
    once = lambda df: df.dropDuplicates(["id"])
    return union([
        problems(once(j.filter(~present)), "tag-without-item", F.col("id"), F.lit("not in the item table")),
        problems(once(j.filter(present & ~F.col("basis").eqNullSafe(F.col("now_basis")))), "tag-basis", F.col("id"),
                 F.coalesce("basis", F.lit(""))),
        problems(once(j.filter(present & (F.col("text_hash") != text_hash(F.col("text"))))), "tag-text", F.col("id"),
                 F.lit("read from other text")),
        problems(rows, "tag-attributes", F.col("id"), F.array_join("have", ",")),
        problems(j.filter(~F.col("answer").isin("yes", "no", "unknown")), "tag-answer",
                 F.concat_ws(".", "id", "attribute"), F.col("answer")),
        problems(j.filter(present & (F.col("answer") == "yes") & unquoted), "tag-quote",
                 F.concat_ws(".", "id", "attribute"), F.lit("yes without the item's own words")),
        problems(untagged.filter(F.coalesce("reason", F.lit("")) == ""), "untagged-reason", F.col("id"), F.lit("no reason")),
        problems(only_in(items, listed, "id"), "item-not-listed", F.col("id"), F.lit("neither tagged nor untagged")),
    ])


def stored_words(readings: DataFrame, items: DataFrame) -> DataFrame:
    """Stored tag readings hold nothing but words of their item."""
    text = item_text(F.col("section"), F.col("name"), F.col("description"))
    texts = items.select(text.alias("text")).distinct().withColumn("key", text_hash(F.col("text")))
    words = F.flatten(F.transform("samples", lambda s: F.flatten(F.map_values(F.coalesce(
        s["w"], F.create_map().cast("map<string,array<string>>"))))))
    j = readings.join(texts, "key").withColumn("_w", words)
    return problems(j.filter(F.exists("_w", lambda w: ~F.contains(F.lower("text"), F.lower(w)))), "reading-words",
                    F.col("key"), F.lit("holds words its item does not contain"))


def food_map(rows: DataFrame, unread: DataFrame, items: DataFrame, labels: DataFrame,
             rules: FoodRules = FoodRules()) -> DataFrame:
    """Every item is mapped, unmapped with a reason, or listed unread; kinds fit their records."""
    kinds = ("label", "usda-single-food", "usda-mixed-dish-estimate", "unmapped")
    kind = F.col("kind")
    own = items.select("id", F.col("kind").alias("item_kind"))
    j = rows.join(own, "id", "left")
    expected = record_kind(F.col("dataType"), F.col("category"), rules)
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    flag = (kind == "usda-mixed-dish-estimate") | F.coalesce(F.col("item_kind") == "menu", F.lit(False))
    seen = rows.select("id").union(unread.select("id"))
    return union([
        problems(j.filter(~F.coalesce(kind.isin(*kinds), F.lit(False))), "map-kind", F.col("id"), F.coalesce(kind, F.lit(""))),
        problems(j.filter(kind == "label").join(labels.select("id"), "id", "left_anti"), "map-label", F.col("id"),
                 F.lit("label mapping without its label")),
        problems(j.filter((kind == "unmapped") & (F.col("fdcId").isNotNull() | (F.coalesce("grams", F.lit(0.0)) != 0)
                                                  | blank("reason"))),
                 "map-unmapped", F.col("id"), F.lit("must carry a reason and no record or weight")),
        problems(j.filter(kind.isin("usda-single-food", "usda-mixed-dish-estimate") & (kind != expected)), "map-record",
                 F.col("id"), F.concat_ws(" / ", "dataType", "category")),
        problems(j.filter(kind.isin(*kinds[1:3]) & ~F.col("estimate").eqNullSafe(flag)), "map-estimate", F.col("id"),
                 F.coalesce(F.col("estimate").cast("string"), F.lit("null"))),
        problems(j.filter(F.col("grams") <= 0), "map-grams", F.col("id"), F.col("grams").cast("string")),
        problems(unread.filter(blank("reason")), "unread-reason", F.col("id"), F.lit("no reason")),
        problems(only_in(items, seen, "id"), "item-not-mapped", F.col("id"), F.lit("neither mapped nor unread")),
        problems(only_in(seen, items, "id"), "map-without-item", F.col("id"), F.lit("not in the item table")),
    ])


def nutrient_bounds(rows: DataFrame, food: str, rules: NutrientRules = NutrientRules()) -> DataFrame:
    """Values outside their bounds, and sums over the limit; one row per finding. Fields are columns."""
    checks = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
                       for f, (lo, hi) in rules.bounds.items()])
    total = sum((F.col(f) for f in rules.sum_fields[1:]), F.col(rules.sum_fields[0]))
    outside = F.transform(
        F.filter(checks, lambda c: c["value"].isNotNull() & ~c["value"].between(c["lo"], c["hi"])),
        lambda c: F.struct(c["field"].alias("field"), c["value"].alias("value")))
    over = F.filter(F.array(F.struct(F.lit("sum").alias("field"), total.alias("value"))),
                    lambda c: c["value"].isNotNull() & (c["value"] > rules.sum_max))
    return each(rows, F.concat(outside, over), "b").select(food, "b.field", "b.value")


def record_set(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Nutrient rows and mapped records are the same set."""
    return union([
        problems(only_in(wanted, rows, "fdcId"), "nutrient-missing", F.col("fdcId"), F.lit("mapped, no row")),
        problems(only_in(rows, wanted, "fdcId"), "nutrient-extra", F.col("fdcId"), F.lit("row, not mapped"))])


def witness(values: DataFrame, copies: DataFrame) -> DataFrame:
    """Values (fdcId, field, nid, value) against an independent copy (fdcId, nid, amount).

    A value off by more than the printed precision of the copy, or absent from
    it, fails. A null is no failure; see ``bulk_gaps``.
    """
    j = values.filter(F.col("value").isNotNull()).join(copies, ["fdcId", "nid"], "left")
    # only records that have a copy at all are witnessed
    j = j.join(copies.select("fdcId").distinct(), "fdcId", "left_semi")
    off = F.col("amount").isNull() | (F.abs(F.col("amount") - F.col("value")) > printed_tolerance(F.col("amount")))
    return problems(j.filter(off), "witness", F.concat_ws(".", F.col("fdcId").cast("string"), "field"),
                    F.concat_ws(" vs ", F.col("value").cast("string"), F.coalesce(F.col("amount").cast("string"), F.lit("none"))))


def bulk_gaps(values: DataFrame, copies: DataFrame, rules: NutrientRules = NutrientRules()) -> DataFrame:
    """Fields null in the table though the copy carries one of their nutrients: a note, not a failure."""
    ids = F.create_map(*[x for f, group in rules.fields.items() for x in (F.lit(f), F.array(*[F.lit(i) for i in group]))])
    empty = values.filter(F.col("value").isNull()).select("fdcId", "field", F.posexplode(ids[F.col("field")]).alias("p", "nid"))
    found = empty.join(copies.select("fdcId", "nid"), ["fdcId", "nid"]).groupBy("fdcId", "field").agg(F.min_by("nid", "p").alias("nid"))
    return problems(found, "null-in-bulk", F.concat_ws(".", F.col("fdcId").cast("string"), "field"),
                    F.concat(F.lit("the copy carries "), F.col("nid").cast("string")), "warn")


def record_cache(records: DataFrame, rules: DocumentRules = DocumentRules()) -> DataFrame:
    """Cached records as text (file, doc): exact fields in order, id equal to the file name, dated."""
    field = lambda name: F.coalesce(F.get_json_object("doc", f"$.{name}"), F.lit(""))
    whole = F.json_object_keys("doc") == F.array(*[F.lit(f) for f in rules.record_fields])
    dated = ((F.concat(field("fdcId"), F.lit(".json")) == F.col("file")) & (field("fetched_at") != "")
             & (field("publicationDate") != ""))
    d = records.withColumn("_whole", F.coalesce(whole, F.lit(False)))
    return union([
        problems(d.filter(~F.col("_whole")), "record-fields", F.col("file"), F.array_join(F.json_object_keys("doc"), ",")),
        problems(d.filter(F.col("_whole") & ~dated), "record-dated", F.col("file"), F.lit("not a dated record of its id"))])


def uncached_mappings(mapped: DataFrame, cached: DataFrame, id_column: str) -> DataFrame:
    bad = mapped.filter(F.col("fdcId").isNotNull()).join(cached.select("fdcId"), "fdcId", "left_anti")
    return problems(bad, "mapping-without-record", F.col(id_column), F.col("fdcId").cast("string"))


def pattern_scan(texts: DataFrame, patterns: Sequence[tuple[str, str]], exempt: Sequence[str] = (),
                 context: int = 30) -> DataFrame:
    """One row per match of each (pattern, label) in (path, text): line, match and context.

    Paths that start with an exempt prefix are skipped. Texts are searched whole.
    """
    for prefix in exempt:
        texts = texts.filter(~F.col("path").startswith(prefix))
    texts = spread(texts)
    out = []
    for pattern, label in patterns:
        regex = F.lit(f"(?iuU){pattern}")
        hit = texts.filter(F.col("text").rlike(f"(?iuU){pattern}"))
        found = F.regexp_extract_all("text", regex, F.lit(0))
        before = F.slice(F.split("text", f"(?iuU){pattern}", -1), F.lit(1), F.size(found))
        pairs = F.arrays_zip(before.alias("gap"), found.alias("match"))
        steps = F.aggregate(
            pairs, F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("starts")),
            lambda acc, p: F.struct(
                (acc["at"] + F.length(p["gap"]) + F.length(p["match"])).alias("at"),
                F.concat(acc["starts"], F.array(acc["at"] + F.length(p["gap"]))).alias("starts")))
        found_rows = hit.withColumn("_f", found).withColumn("_s", steps["starts"])
        each_match = each(found_rows, F.arrays_zip(F.col("_s").alias("at"), F.col("_f").alias("match")), "_m")
        start = F.col("_m.at")
        ahead = F.substring(F.col("text"), F.lit(1), start - 1)
        left = F.greatest(start - context, F.lit(1))
        out.append(each_match.select(
            "path", F.lit(label).alias("label"),
            (F.length(ahead) - F.length(F.translate(ahead, "\n", "")) + 1).alias("line"),
            F.col("_m.match").alias("match"),
            F.substring(F.col("text"), left, start - left + F.length("_m.match") + context).alias("context")))
    return union(out)


def golden(expected: DataFrame, got: DataFrame) -> DataFrame:
    """Expected (case, path, value) rows that the results do not hold: expected is a subset of got."""
    return problems(expected.join(got.select("case", "path", "value"), ["case", "path", "value"], "left_anti"), "golden",
                    F.col("case"), F.concat_ws(" = ", "path", "value"))


def flatten_case(case: str, doc: Mapping, prefix: str = "") -> list[tuple[str, str, str]]:
    """Nested expectation as (case, path, value) rows."""
    rows = []
    for k, v in doc.items():
        path = f"{prefix}.{k}" if prefix else k
        rows += flatten_case(case, v, path) if isinstance(v, Mapping) else [(case, path, str(v))]
    return rows


def reading_rows(readings: DataFrame) -> DataFrame:
    """Stored readings carry their basis, models and samples."""
    bad = ((F.coalesce("basis", F.lit("")) == "") | (F.coalesce(F.size("models"), F.lit(0)) <= 0)
           | (F.coalesce(F.size("samples"), F.lit(0)) <= 0))
    return problems(readings.filter(bad), "reading-basis", F.col("key"), F.lit("no basis, models or samples"))
