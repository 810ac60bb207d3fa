"""URL rules by host-suffix and path-prefix expressions, joined on short hash prefixes and confirmed by full digests.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import fresh

DEFAULT = "allow"   # verdict where no rule fits
SALTS = 16          # parts of the most frequent expressions; the rules are repeated so many times
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), CAPITALS, SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def expressions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, expression) for each host suffix at a label and each path prefix, of those lengths that rules have.

    Every suffix and prefix that can equal a rule's is there; others are spared. The two lists of lengths are no longer
    than the longest host and path of a rule.
    """
    host_lengths = F.collect_set(F.length("rule_host")).alias("host_lengths")
    path_lengths = F.collect_set(F.length("rule_path")).alias("path_lengths")
    urls = urls.withColumns({"host_lengths": rules.agg(host_lengths).scalar(), "path_lengths": rules.agg(path_lengths).scalar()})
    n, p = F.length("host"), F.length("path")
    suffix = F.transform(F.filter("host_lengths", lambda k: (k == n) | ((k < n) & (F.col("host").substr(n - k, F.lit(1)) == "."))), lambda k: F.col("host").substr(n - k + 1, k))
    prefix = F.transform(F.filter("path_lengths", lambda k: k <= p), lambda k: F.col("path").substr(F.lit(1), k))
    return (urls.select("url", F.explode(suffix).alias("h"), prefix.alias("ps")).select("url", "h", F.explode("ps").alias("p"))
            .select("url", F.concat("h", F.lit("\n"), "p").alias("expression")))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules``: rule_host, rule_path, rule_verdict ('allow' or 'block'). A rule fits its host and all hosts below, if the
    path starts with the rule's. The longest rule wins (host and path together), then the longer host, then 'block'.
    Without a fitting rule, rule is null and the verdict 'allow'. Rules with a null host, path or verdict are left out.
    Rule hosts are compared in lower case.

    Null urls, and those without ``://``, have an empty host and path, which only a rule with an empty host fits. Rows
    that repeat stay, each judged alike. Other columns pass; host, path, rule and verdict are replaced. Empty tables: an
    empty result, or no rule.
    """
    kept = pages.drop("host", "path", "rule", "verdict")
    rules = (rules.dropna(subset=["rule_host", "rule_path", "rule_verdict"])
             .select(F.translate("rule_host", CAPITALS, SMALL).alias("rule_host"), "rule_path", "rule_verdict").distinct())
    found = kept.select(F.col(url).alias("url")).distinct().withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    salt = F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int")
    asked = (expressions(found, rules).withColumn("full", digest(F.col("expression")))
             .select("url", "full", F.substring("full", 1, 8).alias("short"), salt.alias("salt")))
    listed = (rules.withColumn("full_rule", digest(F.concat("rule_host", F.lit("\n"), "rule_path")))
              .select("*", F.substring("full_rule", 1, 8).alias("short"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    hits = asked.join(listed, ["short", "salt"]).where(F.col("full") == F.col("full_rule"))
    rank = F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("nh"), (F.col("rule_verdict") == "block").alias("b"),
                    F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict"))
    of = fresh(kept, "_url")
    best = hits.groupBy(F.col("url").alias(of)).agg(F.max(rank).alias("_best"))
    best = best.select(of, F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("verdict"))
    return (kept.join(best, F.col(url).eqNullSafe(F.col(of)), "left")
            .select(*kept.columns, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), "rule", F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict")))


#: Rules of the registered query: host, path, verdict.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def sql(rules: tuple = RULES) -> str:
    """The same in DuckDB, by comparing each page with each of the few rules."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""
WITH r(rule_host, rule_path, rule_verdict) AS (VALUES {values}),
u AS (SELECT page_id, url,
  translate(regexp_extract(coalesce(url, ''), '^(?s:.)*?://([^/?#]*)', 1), '{CAPITALS}', '{SMALL}') AS host,
  regexp_extract(coalesce(url, ''), '^(?s:.)*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
best AS (SELECT url, arg_max((rule_host || rule_path, rule_verdict), length(rule_host) + length(rule_path)) AS best
  FROM (SELECT DISTINCT url, host, path FROM u) JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY url)
SELECT page_id, host, path, best[1] AS rule, coalesce(best[2], '{DEFAULT}') AS verdict FROM u LEFT JOIN best USING (url)"""


def query(pages: DataFrame) -> DataFrame:
    rules = pages.sparkSession.createDataFrame(list(RULES), "rule_host string, rule_path string, rule_verdict string")
    return judge(pages.select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")
