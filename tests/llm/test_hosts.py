import re

from cellwatch.llm.hosts import domain_of, judged, suffix_of
from cellwatch.llm.queries import URL_RULES, page_outcomes
from tests.llm.data import in_order
from pyspark.sql import functions as F

URLS = [
    "https://Example.COM/en/1", "http://www.example.com/en/", "http://a.www.example.com/en/x?y#z", "http://www.example.com/de/en/",
    "http://notexample.com/en/1", "http://x.net/es/1", "http://net/fr/", "http://x.net/esx", "http://x.net", "http://x.net?/es/",
    "http://x.net#/es/", "ftp://user@X.Net:80/es/a://b", "no scheme", "", None, "://", "http:///es/", "a://b://c/es/", "http://É.net/FR/",
    "http://x.net/fr\n/1", "http://org", "http://example.com", "http://xcom/",
]


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]


def ruled(host, path):
    best = None
    for r in URL_RULES:
        h, _, p = r.text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.text) > len(best.text)):
            best = r
    return best


def test_rules_and_parts_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "host string, bad int")
    found = judged(pages, none, URL_RULES).collect()
    want = []
    for i, u in enumerate(URLS):
        host, path = parts(u)
        r = ruled(host, path)
        want.append((i, host, path, r.text if r else None, r.verdict if r else "allow"))
    assert in_order([tuple(r)[:5] for r in found]) == in_order(want)
    assert {r["rule"] for r in found} == {None, *(r.text for r in URL_RULES)}


def test_reputation_shrinks_small_hosts(spark):
    outcomes = [("bad.a.org", 1)] * 200 + [("few.a.org", 1)] * 2 + [("fine.a.org", 0)] * 300 + [("b.org", 0)] * 300 + [("c.org", None)]
    pages = [(i, f"http://{h}/x") for i, h in enumerate(["bad.a.org", "few.a.org", "fine.a.org", "new.a.org", "b.org", "c.org", "z.io"])]
    out = judged(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "host string, bad int"), URL_RULES
    )
    found = {r["host"]: (r["verdict"], r["n_labelled"], r["n_bad"]) for r in out.collect()}
    assert found["bad.a.org"] == ("block", 200, 200)
    assert found["few.a.org"] == ("allow", 2, 2) and found["new.a.org"] == ("allow", 0, 0)
    assert found["fine.a.org"][0] == found["b.org"][0] == found["c.org"][0] == found["z.io"][0] == "allow"


def test_levels_of_a_host(spark):
    df = spark.createDataFrame([("a.b.co.uk",), ("b.co.uk",), ("x.y.org",), ("org",), ("",)], "h string")
    rows = df.select(domain_of(F.col("h")), suffix_of(F.col("h"))).collect()
    assert [tuple(r) for r in rows] == [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("y.org", "org"), ("org", "org"), ("", "")]


def test_empty_and_repeated_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.org/en/5"), (1, "http://a.org/en/5"), (None, None)], "page_id long, url string")
    labels = spark.createDataFrame([(5, 0, 0), (5, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    outcomes = page_outcomes(pages, labels)
    assert [tuple(r) for r in outcomes.collect()] == [("a.org", 1)] * 2
    assert judged(pages, outcomes, URL_RULES).count() == 3
    assert judged(pages.limit(0), outcomes, URL_RULES).count() == 0
