from __future__ import annotations

import re
from urllib.parse import quote

from rowtide.llm.queries import RULES
from rowtide.llm.url_filter import judge_urls, with_domain

URLS = [
    None, "", "no scheme", "://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com", "http://example.com/en/", "http://EXAMPLE.com/EN/",
    "http://a.b.example.com/en/q", "http://www.example.com/en", "http://x.www.example.com/en/1", "http://notexample.com/en/",
    "http://example.com?x=/en/", "http://example.com#/en/", "http://a.net/es/1", "http://net/fr/1", "http://a.net/de/1", "ftp://org/a://b/c",
    "http://ÄÖ.com/ü/'quote", "http://example.com/en/" + "x" * 100_000, "http://host.example.org/", "a://b\nc/d\ne",
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]+", lambda m: m[0].lower(), host), path


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_parts_and_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[6]), (1, URLS[6])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS verdict", "2 AS _n")
    got = judge_urls(pages, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = split(r.url)
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), quote(r.url or "null")[:80]
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_reputation_shrinks(spark):
    """A host without labels takes after its domain; a little-known host of a good domain isn't blocked for one bad page."""
    rows = [(f"http://h{h}.bad.org/{i}", 1) for h in range(20) for i in range(10)]
    rows += [(f"http://h{h}.good.org/{i}", 0) for h in range(20) for i in range(10)]
    rows += [("http://new.bad.org/", None), ("http://new.good.org/", None), ("http://one.good.org/a", 1), ("http://one.good.org/b", None), (None, None)]
    pages = spark.createDataFrame(rows, "url string, bad int")
    got = {r.url: r for r in judge_urls(pages, [], outcome="bad").collect()}
    assert got["http://new.bad.org/"].verdict == "block"
    assert got["http://new.good.org/"].verdict == "allow"
    assert got["http://one.good.org/b"].verdict == "allow"
    assert got["http://one.good.org/b"].bad_share > got["http://new.good.org/"].bad_share
    assert got[None].verdict == "allow"


def test_nothing_known_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [r.verdict for r in judge_urls(pages, []).collect()] == ["allow"]
    assert judge_urls(pages.limit(0), RULES).collect() == []


def test_registered_domains(spark):
    hosts = {
        "a.co.uk": ("a.co.uk", "co.uk"), "x.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.com": ("y.com", "com"), "com": ("com", "com"),
        "10.1.2.3": ("10.1.2.3", "10.1.2.3"), "10.1.2.3:80": ("10.1.2.3", "10.1.2.3"), "host:8080": ("host", "host"), "u:p@w.z.org:1": ("z.org", "org"),
        "w.z.org.": ("z.org", "org"), "": ("", ""), "[::1]:80": ("[::1]", "[::1]"), "com.au": ("com.au", "com.au"), "1.2.3.4.5": ("4.5", "5"),
    }
    got = with_domain(spark.createDataFrame([(h,) for h in hosts], "host string")).collect()
    assert {r.host: (r.domain, r.suffix) for r in got} == hosts
    own = with_domain(spark.createDataFrame([("a.b.c.d",)], "host string"), ["c.d"]).first()
    assert (own.domain, own.suffix) == ("b.c.d", "c.d")


def test_neighbours_under_a_suffix_are_strangers(spark):
    rows = [(f"http://bad{h}.co.uk/{i}", 1) for h in range(5) for i in range(40)] + [(f"http://fine{h}.{s}/{i}", 0) for h in range(40) for s in ("com", "co.uk") for i in range(5)]
    rows += [("http://good.co.uk/", None), ("http://www.bad1.co.uk/", None), ("http://10.0.0.1/", None)] + [(f"http://10.0.0.2:{p}/", 1) for p in range(30)]
    got = {r.url: r.verdict for r in judge_urls(spark.createDataFrame(rows, "url string, bad int"), [], outcome="bad").collect()}
    assert got["http://good.co.uk/"] == "allow" and got["http://www.bad1.co.uk/"] == "block" and got["http://10.0.0.1/"] == "allow"
