import random

import corpus_pipeline
from cellwatch.llm import near
from cellwatch.llm.simhash import fingerprint
from tests.llm.data import documents
from tests.llm.data import rows as sample


def slow_shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def brute(pairs):
    """Smallest id of each class, over all pairs of rows; no null ids."""
    sets = [slow_shingles(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        least[find(i)] = min(d, least.get(find(i), d))
    return set(least.values())


def edited(words, rng, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"e{rng.randrange(10**9)}"
    return " ".join(out)


def groups(seed, families=12, copies=6, words=300):
    rng = random.Random(seed)
    texts = []
    for f in range(families):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        texts += [edited(base, rng, rng.choice((0, 2, 4, 6, 8, 14))) for _ in range(copies)]
    return list(enumerate(texts))


def kept(spark, pairs, **options):
    return {r["doc_id"] for r in near.first_of_each(documents(spark, pairs), **options).collect()}


def test_near_copies_that_differ_in_more_than_two_bits_go(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    pairs = [(1, " ".join(base)), (2, edited(base, rng, 5)), (3, edited(base, rng, 40))]
    assert bin(fingerprint(pairs[0][1]) ^ fingerprint(pairs[1][1])).count("1") > 2
    stage = corpus_pipeline.near_duplicates(spark, documents(spark, pairs), "")
    assert [r["doc_id"] for r in stage.sort("doc_id").collect()] == [1, 3]


def test_classes_equal_all_pairs(spark):
    pairs = groups(1)
    for small_bucket in (1, 32):
        assert kept(spark, pairs, small_bucket=small_bucket) == brute(pairs)


def test_table_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert found == brute(pairs) and not found & {145, 177}


def test_awkward_rows(spark):
    out = near.first_of_each(documents(spark))
    assert out.columns == documents(spark).columns
    ids = [r["doc_id"] for r in out.collect()]
    # 1, 2, 2 and 3 are near copies; the rows without a word are one class.
    assert ids.count(1) == 1 and not {2, 3, 5, 6} & set(ids) and {4, 7, 8, 9, 10, 11} <= set(ids)
    assert len(ids) < len(sample()) and near.first_of_each(documents(spark).limit(0)).count() == 0
