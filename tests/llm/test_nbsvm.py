import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from cellwatch.llm import nbsvm
from cellwatch.llm.queries import QUERIES
from tests.llm.data import documents
from tests.llm.data import rows as sample

SF = "/root/testdata/sf0.01"


def text(rng, good):
    words = [f"w{rng.randrange(200)}" for _ in range(60)]
    return " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)


def labelled(n=400):
    rng = random.Random(2)
    rows = [(i, rng.random() < 0.7) for i in range(n)]
    return [(i, text(rng, g)) for i, g in rows], [(i, int(g), 0) for i, g in rows]


def test_scores_follow_held_out_labels(spark):
    found = QUERIES["op9_quality_classifier"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    r = (
        found.join(labels, "doc_id")
        .filter("held_out")
        .agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right"), F.count(F.lit(1)).alias("n"))
        .first()
    )
    assert r["n"] > 100 and r["right"] > 0.97
    assert found.count() == 1000 and found.filter("score < 0 or score > 1 or score is null").count() == 0


def test_held_out_rows_are_never_learned_from(spark):
    docs, labels = labelled()
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    fit = [nbsvm.learn(documents(spark, docs), spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped)]
    assert (fit[0].weights == fit[1].weights).all() and fit[0].bias == fit[1].bias
    assert (fit[0].slope, fit[0].shift) == (fit[1].slope, fit[1].shift)


def test_only_the_text_counts(spark):
    docs, labels = labelled()
    frame, known = documents(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = nbsvm.learn(frame, known)
    a = {r["doc_id"]: r["score"] for r in nbsvm.scored(frame, model).collect()}
    moved = frame.withColumns({"doc_id": F.col("doc_id") + 1000, "lang": F.lit("xx"), "source": F.lit("s")})
    b = {r["doc_id"] - 1000: r["score"] for r in nbsvm.scored(moved, model).collect()}
    assert a == b
    right = [(a[i] >= 0.5) == bool(q) for i, q, _ in labels]
    assert np.mean(right) > 0.99


def test_bound_on_the_fit_and_repeated_labels(spark):
    docs, labels = labelled()
    frame = documents(spark, [*docs, *docs[:50]])
    known = spark.createDataFrame([*labels, *labels[:30], (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    model = nbsvm.learn(frame, known, max_rows=20)
    assert nbsvm.scored(frame, model).count() == 450


def test_awkward_rows_and_missing_classes(spark):
    docs, labels = labelled(60)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = nbsvm.learn(documents(spark, docs), known)
    rows = nbsvm.scored(documents(spark), model).collect()
    assert len(rows) == len(sample()) and all(0 <= r["score"] <= 1 for r in rows)
    assert nbsvm.scored(documents(spark).limit(0), model).count() == 0
    for few in (known.limit(0), known.filter("quality = 1")):
        model = nbsvm.learn(documents(spark, docs), few)
        assert {r["predicted"] for r in nbsvm.scored(documents(spark, docs), model).collect()} == {1}


def test_ngrams_of_a_long_text_equal_those_in_one_window(monkeypatch):
    t = sample()[9][1]
    whole = nbsvm.ngrams(t)
    monkeypatch.setattr(nbsvm, "_WINDOW", 1000)
    assert (nbsvm.ngrams(t) == whole).all()


def test_the_fit_reads_whole_texts(spark, monkeypatch):
    docs, labels = labelled(40)
    docs = [(i, f"{t} " + " ".join(f"n{i}x{k}" for k in range(4000))) for i, t in docs]
    seen = []
    monkeypatch.setattr(nbsvm, "fit", lambda rows, *a, **b: seen.extend(rows))
    nbsvm.learn(documents(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    whole = {i: nbsvm.ngrams(t) for i, t in docs if zlib.crc32(str(i).encode()) % 3 != 1}
    assert sorted(map(len, seen)) == sorted(map(len, whole.values())) and min(map(len, seen)) > 4000


def test_very_long_texts_stay_within_the_ngram_budget(spark, monkeypatch):
    docs, labels = labelled(300)
    rng = random.Random(5)
    docs = [(i, t if i % 10 else " ".join(f"{rng.randrange(10**6)}" for _ in range(4000))) for i, t in docs]
    docs += docs[:50]
    seen, fit = [], nbsvm.fit
    monkeypatch.setattr(nbsvm, "fit", lambda grams, *a, **k: (seen.append(grams), fit(grams, *a, **k))[1])
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    texts = {i: t for i, t in docs}
    whole = {nbsvm.ngrams(t).astype("<i4").tobytes() for t in texts.values()}
    for budget in (nbsvm.MAX_NGRAMS, 60_000):
        nbsvm.learn(documents(spark, docs), known, max_ngrams=budget)
        assert sum(len(g) for g in seen[-1]) <= budget
        assert all(g.astype("<i4").tobytes() in whole for g in seen[-1])
    free = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(seen[0]) == len(free)
    assert 0 < len(seen[1]) < len(free)


def test_every_labelled_row_is_fitted(spark, monkeypatch):
    """More ids of a class than the 4,000 that were once taken; a repeated row counts once, distinct texts of an id all."""
    docs = [(i, f"t{i}") for i in range(7000)]
    labels = [(i, int(i % 50 > 0), 0) for i in range(7000)]
    seen = []
    monkeypatch.setattr(nbsvm, "fit", lambda rows, good, *a, **k: seen.append((rows, good)))
    frame = documents(spark, [*docs, *docs[:100], (0, "another"), (0, "t0")])
    nbsvm.learn(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    free = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    rows, good = seen[0]
    assert sum(i % 50 > 0 for i in free) > 4000 and good.sum() == sum(i % 50 > 0 for i in free)
    want = [nbsvm.ngrams(docs[i][1]) for i in free] + [nbsvm.ngrams("another")]
    assert sorted(map(bytes, (r.astype("<i4") for r in rows))) == sorted(bytes(w.astype("<i4")) for w in want)


def test_packed_ngrams_come_back():
    for grams in ([], [0], [5, 70_000, 70_001], [0, 3, 65_539], list(range(0, 3000, 7))):
        assert nbsvm._unpacked(nbsvm._packed(np.array(grams, np.int64))).tolist() == grams


def test_blocks_fit_all_rows_as_one_piece_does(spark):
    docs, labels = labelled(300)
    # Some rows that the words do not part, so that the loss stays over zero.
    labels = [(i, q if i % 10 else 1 - q, t) for i, q, t in labels]
    frame, known = documents(spark, [*docs, *docs[:30]]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    once = nbsvm.learn(frame, known)
    free = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    rows, signs = [nbsvm.ngrams(docs[i][1]) for i in free], np.array([2 * labels[i][1] - 1 for i in free])
    ratios = nbsvm.log_count_ratios(rows, signs > 0, nbsvm.BUCKETS)

    def objective(m):
        w = np.divide(m.weights, ratios, out=np.zeros(nbsvm.BUCKETS), where=ratios != 0)
        return (w @ w + m.bias**2) / 2 + sum(max(0, 1 - s * m.margin(f)) for f, s in zip(rows, signs))

    size = sum(len(f) + 1 for f in rows)
    for number, off in ((1, 0.02), (4, 0.3)):
        found = nbsvm.learn(frame, known, local_ngrams=0, block_ngrams=2 * size // number)
        assert abs(objective(found) / objective(once) - 1) < off
        again = nbsvm.learn(frame.repartition(3), known, local_ngrams=0, block_ngrams=2 * size // number)
        assert np.allclose(again.weights, found.weights, atol=1e-6) and np.isclose(again.slope, found.slope)
    one_class = nbsvm.learn(frame, known.filter("quality = 1"), local_ngrams=0)
    assert not one_class.weights.any()


def test_ratios_equal_counts_of_the_classes():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 20, 6)) for _ in range(40)]
    good = rng.random(40) < 0.4
    found = nbsvm.log_count_ratios(rows, good, 20)
    for f in range(20):
        n = {c: 1 + sum(f in r for r, g in zip(rows, good) if g == c) for c in (True, False)}
        all_of = {c: 20 + sum(len(r) for r, g in zip(rows, good) if g == c) for c in (True, False)}
        assert np.isclose(found[f], np.log((n[True] / all_of[True]) / (n[False] / all_of[False])))


def test_dual_descent_reaches_the_least_objective():
    rng = np.random.default_rng(3)
    dims, n = 6, 60
    x = rng.normal(size=(n, dims))
    signs = np.where(x[:, 0] + 0.8 * rng.normal(size=n) > 0, 1.0, -1.0)
    costs = np.where(signs > 0, 0.5, 1.5)
    rows = [(np.arange(dims), v) for v in x]
    w, bias = nbsvm.dual_coordinate_descent(rows, signs, dims, costs, epochs=2000)

    # The bias is a weight of a constant column; plain subgradient steps from zero, the best point seen.
    full = np.hstack([x, np.ones((n, 1))])

    def objective(v):
        return 0.5 * v @ v + costs @ np.maximum(0, 1 - signs * (full @ v))

    v, best = np.zeros(dims + 1), np.inf
    for t in range(1, 20001):
        active = signs * (full @ v) < 1
        v = v - (v - (costs * signs * active) @ full) / (t + 10)
        best = min(best, objective(v))
    assert objective(np.append(w, bias)) <= best * 1.001
