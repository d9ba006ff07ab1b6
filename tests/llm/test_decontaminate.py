import math
import re

import pytest

from cellwatch.llm.decontaminate import contained_items, decontaminated, item_shingles
from tests.llm.data import documents, got, in_order

FILLER = " ".join(f"f{i}" for i in range(300))
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items, threshold=0.8):
    best = {}
    for i, t in docs:
        v = words(t)
        for j, u in items:
            w = words(u)
            if not w:
                continue
            k = min(5, len(w))
            s = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)}
            d = {tuple(v[a : a + k]) for a in range(len(v) - k + 1)}
            n = len(s & d)
            if n >= math.ceil(threshold * len(s) - 1e-9):
                best[i, j] = max(best.get((i, j), (0, 0, 0)), (n / len(s), len(s), n))
    return in_order([(i, j, n, m, c) for (i, j), (c, n, m) in best.items()])


DOCS = [
    (1, f"{FILLER} {ITEM} {FILLER}"),
    (2, f"{FILLER} {ITEM.upper().replace(' ', ', ')}. {FILLER}"),
    (3, f"{FILLER} {ITEM.replace('one', 'uno')} {FILLER}"),  # one of ten shingles lost
    (4, f"{FILLER} {ITEM.replace('seven', 'siete')} {FILLER}"),  # half lost
    (5, FILLER),
    (6, "a short item"),
    (7, "short"),
    (8, None),
    (9, ""),
    (10, "!!! ..."),
    (None, ITEM),
    (11, ITEM),
    (11, "something else"),
    (11, ITEM),
]
ITEMS = [(1, ITEM), (2, "short item"), (3, "short"), (4, None), (5, ""), (6, "?!"), (7, ITEM), (8, "not there at all in any"), (9, "absent")]


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_equals_brute_force(spark, broadcast_rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = contained_items(documents(spark, DOCS), items, broadcast_rows=broadcast_rows)
    assert got(found, "doc_id", "item_id", "n_shingles", "n_found", "containment") == brute(DOCS, ITEMS)
    kept = decontaminated(documents(spark, DOCS), items, broadcast_rows=broadcast_rows)
    bad = {i for i, *_ in brute(DOCS, ITEMS)}
    assert got(kept, "doc_id", "text") == in_order([(i, t) for i, t in DOCS if i not in bad])
    assert kept.columns == documents(spark).columns


def test_a_sketch_always_meets_a_contained_item(spark):
    """Whatever shingles an item may lose, its sketch is longer than their number."""
    many = [(n, " ".join(f"{n}x{i}" for i in range(n + 4))) for n in range(1, 120)]
    rows = item_shingles(spark.createDataFrame(many, "item_id long, text string"), "item_id", "text", 5, 0.8).collect()
    assert len(rows) == 119
    for r in rows:
        assert r["n_shingles"] == r["item_id"]
        assert len(r["sketch"]) > r["n_shingles"] - r["needed"]
        assert r["needed"] == math.ceil(0.8 * r["n_shingles"] - 1e-9)


def test_empty_tables(spark):
    docs, items = documents(spark, DOCS), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contained_items(docs.limit(0), items).count() == 0
    assert contained_items(docs, items.limit(0)).count() == 0
    assert decontaminated(docs, items.limit(0)).count() == len(DOCS)


def test_main_path_has_no_python(spark):
    docs, items = documents(spark, DOCS), spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = contained_items(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
