"""URL rules against a plain search over all rules."""

import random

from larderline.llm import url_filter as U

RULES = "rule_host string, rule_path string, rule_verdict string"


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        tail = rest[end:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[3] if best else None, best[4] if best else "allow"


URLS = [None, "", "example.com/en/", "http://", "://a.com/x", "http://EXAMPLE.com/en/x?y#z", "http://www.example.com/en/", "http://m.www.example.com/en/1#q/es/",
        "https://xexample.com/en/", "https://example.com", "https://example.com?/en/", "https://a.net/es/1", "https://net/fr/", "https://a.net/es", "http://u@example.com:80/en/",
        "http://a.com.:80/", "http://é.com/é/", "http://a\nb.com/en/\nx?y", "http://x://example.com/en/", "http://" + "a." * 3000 + "com/" + "y/" * 3000, "http://.com/", "http://com/"]


def test_query_rules(spark):
    rows = [(i % 15, u) for i, u in enumerate(URLS + URLS[:6])] + [(None, URLS[5])]
    got = sorted(map(tuple, U.query(spark.createDataFrame(rows, "page_id long, url string")).collect()), key=repr)
    assert got == sorted(((i, *plain(u, U.RULES)) for i, u in rows), key=repr)


def test_random_rules_of_all_lengths(spark):
    rng = random.Random(8)
    label = lambda: rng.choice(["a", "b", "ab", "com", ""])
    rules = {(".".join(label() for _ in range(rng.randint(1, 3))), rng.choice(["", "/", "/a", "/a/", "/a/b", "/ab"]), rng.choice(["allow", "block"])) for _ in range(60)}
    urls = [f"http://{'.'.join(label() for _ in range(rng.randint(1, 4)))}{rng.choice(['', '/', '/a', '/a/b/c', '/ab?x', '/b'])}" for _ in range(400)]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, full string")
    bad = [(None, "/", "allow"), ("com", None, "block"), ("com", "/", None)]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.judge(df, spark.createDataFrame(list(rules) + bad, RULES)).collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_no_rules_and_no_pages(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], RULES)
    assert [tuple(r) for r in U.judge(df, none).collect()] == [(1, "http://a.com/", "a.com", "/", None, "allow")]
    assert U.query(df.limit(0)).count() == 0
