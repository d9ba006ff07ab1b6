import random

import pytest

from cellwatch.llm import spelling
from cellwatch.llm.queries import mangled_words
from tests.llm.data import documents, got


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return a[p + 1 :] == b[p + 1 :] or a[p + 1 :] == b[p:] or a[p:] == b[p + 1 :]


def brute(counts, ratio=10):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows)


def words(seed, n, letters, sizes):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.choice(sizes)))
        out.add(w)
        for _ in range(3):
            i = rng.randrange(len(w) + 1)
            out.add(rng.choice((w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :])))
    return {w: rng.choice((2, 3, 20, 30, 200, 300, 4000)) for w in sorted(out) if w}


CASES = {
    "dense": words(1, 150, "abc", (4, 5, 6)),
    "accents": words(2, 200, "aéÿ×bÀ", (7, 8)),
    "long": words(3, 30, "ab", (40, 300)) | {"x" * n: n * n for n in range(1, 12)},
    "one letter": {"a": 2, "b": 20, "ab": 300, "c": 3},
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_groups_equal_all_pairs(spark, name):
    counts = CASES[name]
    out = spelling.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert sorted(tuple(r) for r in out.collect()) == brute(counts)


def test_very_long_words(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("abc") for _ in range(20_000))
    counts = {long: 3, long[:7] + long[8:]: 40, long[:-1] + "z": 2, long + "a": 2, "abcdefgh": 2}
    out = spelling.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert sorted(tuple(r) for r in out.collect()) == brute(counts)


def test_awkward_rows(spark):
    frame = spark.createDataFrame([(None,), ("",), ("shorter",), ("shorter",), ("two",), ("two",)], "word string")
    assert got(spelling.word_counts(frame), "word", "n") == [("shorter", 2)]
    assert spelling.variant_groups(spark.createDataFrame([], "word string, n long")).count() == 0
    wide = spark.createDataFrame([("shorter", 2, "x", 1), (None, 5, "y", 2)], "word string, n long, form string, node int")
    assert [tuple(r) for r in spelling.variant_groups(wide).collect()] == [("shorter", None, "shorter", 2, 0, None)]
    with pytest.raises(ValueError):
        spelling.variant_groups(wide, ratio=1)


def test_runs_of_awkward_documents(spark):
    import re
    import zlib

    want = {}
    docs = documents(spark)
    for r in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= 3:
                want[low] = want.get(low, 0) + 1
    found = spelling.word_counts(mangled_words(docs, 3), min_length=3, min_count=1)
    assert {r["word"]: r["n"] for r in found.collect()} == want
