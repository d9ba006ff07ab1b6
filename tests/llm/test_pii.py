import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellwatch.llm import pii
from cellwatch.llm.queries import op12
from tests.llm.data import documents, got, rows

SF = "/root/testdata/sf0.001"
# The fixed patterns as they are written in the contract, leftmost and greedy.
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                0: lambda: True,
                1: lambda: all(int(p) <= 255 for p in m.group().split(".")),
                2: lambda: 16 <= len(digits) <= 19 and plain_luhn(digits),
                3: lambda: 8 <= len(digits) <= 15,
            }
            if good[kind]():
                out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([
    "a", "b.c", "@", ".", " ", "-", "%", "+1", "(2)", "7", "42", "255", "256", "0", "4111111111111111", "é", "\n", "+", "1.2.3.4", "(", ")",
    "name@host.com", "+1 (487) 555-7209", "192.168.0.1", "4736962573099581", "00300", " at ", " dot ",
]), max_size=14))
def test_fixed_patterns_equal_plain_search(parts):
    text = "".join(parts)
    assert sorted(pii.base_spans(text)) == sorted(brute(text))
    for kind, start, end in pii.proposals(text):
        assert 0 <= start < end <= len(text) and 0 <= kind < 4
        assert len(pii.features(text, (kind, start, end))) == len(pii.FEATURES)


def slow_margins(trees, x):
    out = []
    for row in x:
        total = trees.start
        for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            at = 0
            while at < len(feature):
                at = 2 * at + (2 if row[feature[at]] > threshold[at] else 1)
            total += leaf[at - len(feature)]
        out.append(total)
    return np.array(out)


def test_first_split_is_the_best_of_all():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (200, 4)).astype(float)
    y = ((x[:, 2] > 3) ^ (rng.random(200) < 0.1)).astype(float)
    trees = pii.fit_trees(x, y)
    p = y.mean()
    g, h = p - y, np.full(200, p * (1 - p))

    def gain(j, c):
        left = x[:, j] <= c
        return sum(g[s].sum() ** 2 / (h[s].sum() + pii.PENALTY) for s in (left, ~left))

    best = max((gain(j, c), j, c) for j in range(4) for c in range(5))
    assert np.isclose(gain(trees.feature[0][0], trees.threshold[0][0]), best[0])
    assert np.allclose(trees.margins(x), slow_margins(trees, x))
    assert ((trees.margins(x) > 0) == y).mean() > 0.85
    assert pii.fit_trees(np.zeros((0, 4)), np.zeros(0)).margins(x).std() == 0


def test_threshold_is_where_the_increasing_fit_reaches_the_precision():
    margins = np.array([-3, -2, -1, 0, 1, 2, 3, 4, 5, 5.0])
    y = np.array([0, 0, 1, 0, 1, 0, 1, 1, 1, 1.0])
    assert pii.calibrated(margins, y, 0.95) == 3
    assert pii.calibrated(margins, y, 0.5) == -1
    assert pii.calibrated(margins, 0 * y) == float("inf") and pii.calibrated(margins[:0], y[:0]) == float("inf")


def test_hidden_data_is_found_and_plain_numbers_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.learn(docs)
    hidden = [
        ("email", "thonion the ", "anna.berg42 [at] mail3 [dot] example [dot] com"),
        ("card", "in that ", "4111.1111.1111.1111"),
        ("phone", "erthen. ", "+1 (426) 555-4081 190.137.223.204"),
    ]
    for kind, before, text in hidden:
        whole = before + text + " in the onion."
        base = pii.base_spans(whole)
        added = model.added(whole, base)
        assert [pii.KINDS[s[0]] for s, _ in added] == [kind]
    for clean in ("on 2024-01-05 at 10:30", "version 1.2.3.400 of", "order 3818120573288004 in", "about 1,000,000 or 3.14159", "at noon. Then", "us @ home. Then", "one (at) noon. It"):
        assert not model.added(f"the {clean} that", pii.base_spans(clean))


def test_query_equals_plain_search_and_keeps_it(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {}
    for r in docs.collect():
        spans = sorted(brute(r["text"] or ""))
        want[r["doc_id"]] = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans]
    out = op12(spark, SF).collect()
    assert len(out) == docs.count()
    for r in out:
        base = want[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b.startswith(k) for b in base) for k in pii.KINDS]
        assert set(base) <= set(filter(None, r["spans"].split(",")))
    assert any(want.values())


def test_awkward_rows(spark):
    docs = documents(spark, [*rows(), (50, "x" * 300_000 + "@a.b"), (51, "12 34 " * 2_000), (52, "mail me: a@b.cd, a@b.cd"), (52, "+1 234 5678")])
    model = pii.learn(docs)
    out = pii.with_spans(docs, model)
    assert out.columns == [*docs.columns, "spans"] and out.count() == docs.count()
    found = {r["doc_id"]: r for r in out.filter("doc_id >= 50").collect()}
    assert [(s["start"], s["end"]) for s in found[50]["spans"]] == [(0, 300_004)]
    assert got(out.filter("text is null").selectExpr("size(spans) AS n"), "n") == [(0,)] * 2
    assert pii.with_spans(docs.limit(0), model).count() == 0
    empty = pii.learn(docs.limit(0))
    assert empty.thresholds == (float("inf"),) * 4 and empty.added("name [at] host [dot] com", []) == []


def test_redaction(spark):
    frame = spark.createDataFrame([("é a@b.cd and 1.2.3.4!", [("email", 2, 8), ("ip", 13, 20)]), (None, None), ("none", [])],
                                  "text string, spans array<struct<kind: string, start: int, end: int>>")
    out = [r[0] for r in frame.select(pii.redacted(frame["text"], frame["spans"])).collect()]
    assert out == ["é [EMAIL] and [IP]!", None, "none"]


def test_every_document_counts_in_the_fit(spark):
    # More documents than a sample of 20,000 takes; only those that its hash leaves out hold personal data.
    ids = spark.range(60_000).withColumnRenamed("id", "doc_id")
    rare = F.expr("pmod(xxhash64(doc_id), 2147483648L) >= 1500000000L AND doc_id % 25 = 0")
    data = F.concat(F.lit("mail me: a"), "doc_id", F.lit("@b.org or call +1 426 555 "), F.lpad(F.col("doc_id") % 10_000, 4, "0"), F.lit(" now"))
    docs = ids.withColumn("text", F.when(rare, data).otherwise("plain words"))
    counted = pii.counted_examples(docs).agg(F.sum("n"), F.sum("good")).first()
    found = [y for r in docs.filter(rare).collect() for _, y in pii.examples(r["text"])]
    assert tuple(counted) == (len(found), sum(found))
    model = pii.learn(docs)
    assert np.isfinite([model.thresholds[pii.EMAIL], model.thresholds[pii.PHONE]]).all()


def test_fit_over_tasks_equals_the_fit_in_memory(spark):
    docs = documents(spark, [(i, f"ask x{i % 7}@mail.org or 192.168.{i % 9}.{i % 11} on {i % 5} 2024") for i in range(300)])
    fitted = pii.counted_examples(docs).filter("part <> 0")
    cuts, counts = pii._exact_cuts(fitted), {}
    for r in fitted.collect():
        x = np.frombuffer(r["x"])
        row = counts.setdefault((x[:4].argmax(), *pii._binned(x[None], cuts)[0].tolist()), np.zeros(2))
        row += r["n"], r["good"]
    bins = np.array(list(counts), np.uint8)[:, 1:]
    n, good = np.array(list(counts.values())).T

    def sums(trees, *splits):
        return pii._sums(bins, n, good, trees.margins(bins), *splits)

    here = pii._unbinned(pii._grown(len(cuts), pii._start(n.sum(), good.sum()), sums), cuts)
    there = pii.learn(docs).trees
    assert (here.feature == there.feature).all() and (here.threshold == there.threshold).all()
    assert np.allclose(here.leaf, there.leaf)


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 4)), max_size=30), st.integers(0, 30))
def test_ranges_pooled_apart_give_the_same_blocks(counts, cut):
    blocks = [(float(i), min(good, n), n) for i, (good, n) in enumerate(counts)]
    assert pii._pooled(pii._pooled(blocks[:cut]) + pii._pooled(blocks[cut:])) == pii._pooled(blocks)
