import random
import re

import pytest
import xxhash

from cellwatch.llm.components import components
from cellwatch.llm.simhash import fingerprint, first_of_each, links, near_duplicates, pairs_within
from tests.llm.data import documents, got, in_order
from tests.llm.data import rows as sample


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not w:
        return 0
    shingles = [" ".join(w)] if len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(points, distance=2):
    """Smallest point of each point's class, over all pairs."""
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    points = sorted(points)
    for i, a in enumerate(points):
        for b in points[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in points}


def clusters(seed, n=60, spread=14):
    """Fingerprints in dense clouds, in chains and alone, as signed longs."""
    rng = random.Random(seed)
    found = {rng.getrandbits(64) for _ in range(30)}
    for _ in range(3):
        centre = rng.getrandbits(64)
        bits = rng.sample(range(64), spread)
        for _ in range(n):
            found.add(centre ^ sum(1 << b for b in rng.sample(bits, rng.randrange(0, 4))))
    at = rng.getrandbits(64)
    for b in range(0, 40, 2):
        at ^= 3 << b
        found.add(at)
    return [p - 2**64 if p >= 2**63 else p for p in found]


def test_fingerprint_equals_slow_one():
    rng = random.Random(1)
    texts = [t for _, t in sample() if t is None or len(t) < 5000]
    texts += [" ".join(rng.choice("abcdEÉ") for _ in range(rng.randrange(40))) for _ in range(200)]
    for t in texts:
        assert fingerprint(t) == slow_fingerprint(t)


@pytest.mark.parametrize("small_bucket", [1, 4, 1000])
def test_classes_equal_all_pairs(spark, small_bucket):
    points = clusters(small_bucket)
    frame = spark.createDataFrame([(p,) for p in points], "fp long")
    found = links(frame, small_bucket=small_bucket).collect()
    for a, b in found:
        assert a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2
    want = classes(points)
    assert classes_of(points, found) == want
    joined = {r["node"]: r["root"] for r in components(spark.createDataFrame(found or [(0, 0)], "a long, b long"), "a", "b").collect()}
    assert {p: joined.get(p, p) for p in points} == want


def classes_of(points, pairs):
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {p: find(p) for p in points}


def test_long_chain_is_one_component(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1001)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert found == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def brute(pairs):
    fps = [slow_fingerprint(t) if t is None or len(t) < 5000 else fingerprint(t) for _, t in pairs]
    root = classes(set(fps))
    least = {}
    for (i, _), f in zip(pairs, fps):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return [(i, f - 2**64 if f >= 2**63 else f, least.get(root[f])) for (i, _), f in zip(pairs, fps)]


def test_near_duplicates_equal_brute_force(spark):
    pairs = sample()
    found = near_duplicates(documents(spark, pairs))
    assert got(found, "doc_id", "fp", "component_id") == in_order(brute(pairs))


def test_one_of_each_class_stays(spark):
    pairs = sample()
    kept = first_of_each(documents(spark, pairs))
    assert kept.columns == documents(spark).columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    found = brute(pairs)
    root = classes({f for _, f, _ in found})
    members = {}
    for p, (i, f, c) in zip(pairs, found):
        members.setdefault(root[f], set()).add(p)
        if p in rows:
            assert i == c  # the smallest id of its class
    assert all(sum(p in rows for p in own) == 1 for own in members.values()) and len(rows) == len(members)


def test_other_distances_are_refused(spark):
    with pytest.raises(ValueError):
        links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_empty_table(spark):
    assert near_duplicates(documents(spark).limit(0)).count() == 0
    assert first_of_each(documents(spark).limit(0)).count() == 0


@pytest.mark.parametrize("distance, block", [(0, 1024), (2, 4), (5, 8), (11, 16)])
def test_any_distance_equals_all_pairs(spark, distance, block):
    points = sorted(clusters(9, n=25))
    found = sorted(tuple(r) for r in pairs_within(spark.createDataFrame([(p,) for p in points], "fp long"), distance, block).collect())
    want = [(a, b) for i, a in enumerate(points) for b in points[i + 1 :] if bin((a ^ b) & (2**64 - 1)).count("1") <= distance]
    assert found == want
