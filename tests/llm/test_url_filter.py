import random

import pytest

from tessera.llm import queries, url_filter

RULES = "host string, path string, verdict string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = lambda s, chars: min([s.find(c) for c in chars if c in s], default=len(s))
    host = rest[: cut(rest, "/?#")]
    tail = rest[len(host) :]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[: cut(tail, "?#")]


def brute(url, rules, default="allow"):
    host, path = parts(url)
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules
            if None not in (h, p, v) and host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    best = max(fits)
    return host, path, best[3], best[2]


def run(spark, urls, rules, extra=False):
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    if extra:
        pages = pages.selectExpr("*", "'x' AS rule", "'x' AS node", "1 AS depth", "'x' AS _row")
    out = url_filter.filter_urls(pages, spark.createDataFrame(rules, RULES)).collect()
    assert len(out) == len(urls)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out}


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "https://example.com/en/", "https://example.com/en",
        "http://a.b.example.com/en/1#x", "http://example.com?x=/en/", "http://x.net/es/1", "http://x.net/fr", "http://net/es/", "ftp://badexample.com/en/",
        "http://user@example.com:80/en/", "http://example.com/en/\u00e9\U0001F600", "a://b://c/d", "http://é.com/", "http://..com/", "http://www.example.com/en/deep/er"]


@pytest.mark.parametrize("extra", [False, True])
def test_contract_rules(spark, extra):
    got = run(spark, URLS * 2, queries.URL_RULES, extra)
    for i, u in enumerate(URLS * 2):
        assert got[i] == brute(u, queries.URL_RULES), u


def test_nested_repeated_and_null_rules_over_many_blocks(spark):
    r = random.Random(5)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "com", "net", "x.net"]
    paths = ["", "/", "/p", "/p/", "/p/q", "/p/q/r", "/z"]
    rules = [(r.choice(hosts), r.choice(paths), r.choice(["allow", "block"])) for _ in range(60)] + [(None, "/", "block"), ("com", None, "block"), ("com", "/", None)]
    rules += rules[:10]
    urls = [f"http://{r.choice(['', 'w.', 'v.w.'])}{r.choice(hosts)}{r.choice(paths)}{r.choice(['', 'x', '/y', '?k'])}" for _ in range(400)]
    urls += ["http://c.b.a.com/p/q/r/s"] * 300  # one hot url
    got = run(spark, urls, rules)
    for i, u in enumerate(urls):
        assert got[i] == brute(u, rules), u


def test_empty_tables(spark):
    assert run(spark, [], queries.URL_RULES) == {}
    assert run(spark, ["http://a.com/"], []) == {0: ("a.com", "/", None, "allow")}
