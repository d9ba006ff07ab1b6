import random

import pytest
from pyspark.sql import functions as F

from cellwatch.llm.warc import canonical_url, resolved_revisits
from tests.llm.data import in_order

SCHEMA = (
    "record_id long, kind string, url string, ts long, etag string, last_modified string, headers map<string,string>, "
    "payload_digest string, canonical string, part int, found string, status string"
)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)


def brute(rows):
    out = []
    for i, kind, url, ts, tag, date, _, _ in rows:
        if kind != "revisit":
            continue
        earlier = [r for r in rows if r[1] == "response" and url is not None and r[2] == url and None not in (ts, r[3]) and r[3] < ts]
        if not earlier:
            out.append((i, "no_earlier_response", None))
            continue
        s = max(earlier, key=lambda r: (r[3], r[0]))
        weak = lambda t: t.removeprefix("W/")
        if tag is not None and s[4] is not None:
            status = "resolved" if weak(tag) == weak(s[4]) else "validator_mismatch"
        elif date is not None and s[5] is not None:
            status = "resolved" if date == s[5] else "validator_mismatch"
        else:
            status = "no_validator"
        out.append((i, status, s[0]))
    return in_order(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_with_a_hot_url(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(900):
        kind = rng.choice(["response", "revisit", "request"])
        url = "a.org/hot" if i % 3 else rng.choice(["a.org/1", "a.org/2", "b.org", None])
        tag = rng.choice(['"1"', 'W/"1"', '"2"', None])
        ts = rng.choice([None, *range(0, 400)]) if i % 50 else 7
        rows.append((i, kind, url, ts, tag, rng.choice(["mon", "tue", None]), {"A": "1"}, f"d{i}"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = resolved_revisits(frame(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert in_order([(r["record_id"], r["status"], r["response_id"]) for r in found]) == brute(rows)
    for r in found:
        assert (r["payload_digest"] == f"d{r['response_id']}") if r["status"] == "resolved" else r["payload_digest"] is None


def test_headers_are_merged_where_permitted(spark):
    rows = [
        (1, "response", "http://a.org/x", 1, '"t"', None, {"Content-Type": "text/html", "Cache-Control": "a", "Age": "1"}, "d"),
        (2, "revisit", "https://www.A.org/x/#y", 2, 'W/"t"', None, {"CONTENT-TYPE": "no", "cache-control": "b", "X-New": "c", "Connection": "close"}, None),
        (3, "revisit", "http://a.org/x", 3, '"t"', None, None, None),
        (4, "revisit", "http://a.org/x", 1, '"t"', None, None, None),
    ]
    found = {r["record_id"]: r for r in resolved_revisits(frame(spark, rows)).collect()}
    assert [tuple(h) for h in found[2]["headers"]] == [("age", "1"), ("cache-control", "b"), ("content-type", "text/html"), ("x-new", "c")]
    assert [tuple(h) for h in found[3]["headers"]] == [("age", "1"), ("cache-control", "a"), ("content-type", "text/html")]
    assert found[4]["status"] == "no_earlier_response" and found[4]["headers"] is None


def test_canonical_urls(spark):
    cases = {
        "HTTP://WWW.Example.com:80/A/?utm_source=x#f": "example.com/A",
        "https://example.com:443": "example.com",
        "http://e.com/a?utm_a=1&b=2&utm_c=3": "e.com/a?b=2",
        "e.com/": "e.com",
        "": "",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "u string").select("u", canonical_url(F.col("u")).alias("c"))
    assert {r["u"]: r["c"] for r in df.collect()} == cases | {None: None}


def test_repeated_rows_and_empty_table(spark):
    row = (5, "revisit", "http://a.org", 9, None, None, None, None)
    first = (4, "response", "http://a.org", 8, None, None, None, "d")
    found = resolved_revisits(frame(spark, [row, row, first, first]))
    assert [(r["record_id"], r["status"], r["response_id"]) for r in found.collect()] == [(5, "no_validator", 4)] * 2
    assert resolved_revisits(frame(spark, [row]).limit(0)).count() == 0
