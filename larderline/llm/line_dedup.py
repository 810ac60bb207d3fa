"""Removal of lines that stand on many sites: HyperLogLog sketches per line, exact counts near the threshold.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import fresh


@dataclass(frozen=True)
class LineRules:
    min_sites: int = 5       # a line on so many sites, or more, is boilerplate
    sketch_bits: int = 12    # 2**12 registers: standard error 1.6 %
    sigmas: float = 6.0      # estimates within so many standard errors of the threshold are counted exactly
    keep_first: bool = True  # the first copy of the line stays, so that no text is lost from the corpus


def is_blank(line: Column) -> Column:
    return ~line.rlike(r"[^\x20\x09-\x0D]")


BLANKS = " \t\n\x0b\x0c\r"


def line_keys(line: Column) -> list[Column]:
    """128 bits that stand for a line, without ASCII blanks at its ends."""
    line = F.btrim(line, F.lit(BLANKS))
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("second"), line).alias("h2")]


def lines_of(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """A row per line with a character: h1, h2, site, at = (d: id, t: hash of the text, pos)."""
    key = F.struct(F.col(doc_id).alias("d"), F.xxhash64(F.col(text)).alias("t"))
    exploded = (docs.where(F.col(text).isNotNull())
                .select(key.alias("k"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line"))
                .where(~is_blank(F.col("line"))))
    return exploded.select(*line_keys(F.col("line")), "site", F.struct("k.d", "k.t", "pos").alias("at"))


def spread_lines(lines: DataFrame, rules: LineRules) -> DataFrame:
    """Lines on at least ``min_sites`` sites: h1, h2, first (where the line stands first).

    A sketch of the sites of each line merges by aggregation, map side first. Where the estimate is clear it decides;
    lines within the error band of the threshold get an exact distinct count.
    """
    seen = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", rules.sketch_bits)).alias("sites"), F.min("at").alias("first"))
    band = max(1, round(rules.sigmas * 1.04 / 2 ** (rules.sketch_bits / 2) * rules.min_sites + 0.5))
    seen = seen.where(F.col("sites") >= rules.min_sites - band)
    near = F.col("sites") <= rules.min_sites + band
    # a line in many documents of a site comes once from each task
    counted = (lines.select("h1", "h2", "site").distinct().join(seen.where(near).select("h1", "h2"), ["h1", "h2"], "left_semi")
               .groupBy("h1", "h2").agg(F.count("*").alias("exact")).where(F.col("exact") >= rules.min_sites))
    return seen.where(~near).select("h1", "h2", "first").union(seen.where(near).join(counted, ["h1", "h2"]).select("h1", "h2", "first"))


def remove_spread_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", rules: LineRules = LineRules(),
                        names: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` without boilerplate lines, and n_lines, n_removed under these or other ``names``.

    A line is what stands between line ends, compared without ASCII blanks (CR and tab, too) at its ends. If it stands on ``min_sites``
    distinct sites or more, it goes everywhere but (``keep_first``) where it stands first: lowest id, then lowest hash
    of the text, then position. Within one document a later repeat of such a line goes too.

    Blank lines never go. A null text stays null with 0 lines; an empty text has one (blank) line. A null site counts
    as one site without a name; a null id comes before all others. Rows that repeat (id and text) are one document:
    each copy keeps and loses the same lines. All other columns pass, whatever their names; an empty table gives
    an empty result. Columns of the two names are replaced.
    """
    docs = docs.drop(*names)
    lines = lines_of(docs, doc_id, text, site)
    spread = spread_lines(lines, rules)
    gone = lines.join(spread, ["h1", "h2"])
    if rules.keep_first:
        gone = gone.where(~F.col("at").eqNullSafe(F.col("first")))
    gone = gone.groupBy(F.col("at.d").alias("_d"), F.col("at.t").alias("_t")).agg(F.collect_set("at.pos").alias("_gone"))
    own = {n: fresh(docs, n) for n in ("_d", "_t", "_gone")}
    gone = gone.select(*(F.col(n).alias(own[n]) for n in own))
    both = docs.join(gone, F.col(doc_id).eqNullSafe(F.col(own["_d"])) & (F.xxhash64(F.col(text)) == F.col(own["_t"])), "left")
    taken, split = F.col(own["_gone"]), F.split(F.col(text), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), taken)
    rest = F.array_join(F.transform(kept, lambda i: split[i]), "\n")
    return both.select(*(F.when(taken.isNull(), F.col(text)).otherwise(rest).alias(c) if c == text else F.col(c) for c in docs.columns),
                       F.when(F.col(text).isNull(), 0).otherwise(F.size(split)).cast("long").alias(names[0]),
                       F.when(taken.isNull(), 0).otherwise(F.size(taken)).cast("long").alias(names[1]))


def sql(docs: str = "documents", columns: str = "doc_id, text, n_lines, n_removed", rules: LineRules = LineRules()) -> str:
    """The same in DuckDB, by exact counts. Ids are taken as unique there."""
    return f"""
WITH doc_lines AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM {docs} WHERE text IS NOT NULL),
full_lines AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM doc_lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
spread AS (SELECT k, min((doc_id, pos)) AS first FROM full_lines GROUP BY k HAVING count(DISTINCT site) >= {rules.min_sites}),
gone AS (SELECT doc_id, pos FROM full_lines JOIN spread USING (k) WHERE (doc_id, pos) <> first),
rest AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL) AS rest, count(*) AS n_lines, count(g.pos) AS n_removed
  FROM doc_lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id),
cleaned AS (
  SELECT d.* REPLACE (CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.rest, '') END AS text), coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
  FROM {docs} d LEFT JOIN rest r ON d.doc_id = r.doc_id)
SELECT {columns} FROM cleaned"""
