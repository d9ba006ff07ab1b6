import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from cellwatch.llm.packing import best_fit_decreasing, cut, dual_bound, pack, packed_documents, token_pieces
from cellwatch.llm.queries import tokenizer_file
from tests.llm.data import documents, got, in_order
from tests.llm.data import rows as sample

PATH = tokenizer_file()


def fewest(lengths, capacity):
    """Exact number of bins for a few pieces, by search."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in {b: j for j, b in enumerate(bins)}.values():
            if bins[k] + lengths[i] <= capacity:
                place(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1 :]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


def test_bound_never_exceeds_the_fewest_bins():
    rng = random.Random(5)
    for _ in range(300):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        bins = best_fit_decreasing(np.array(lengths), 20)[0].max() + 1
        assert dual_bound(counts, 20) <= fewest(lengths, 20) <= bins
    assert dual_bound({600: 5}, 1024) == 5 and dual_bound({342: 4}, 1024) == 2 and dual_bound({}, 1024) == 0


def test_cut():
    assert cut(1, 1024) == [(0, 1)] and cut(1024, 1024) == [(0, 1024)]
    assert cut(1025, 1024) == [(0, 1), (1, 1024)] and cut(2048, 1024) == [(0, 1024), (1024, 1024)]


def check_places(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("low, high", [(1, 1024), (1, 200), (520, 700), (300, 600), (1024, 1024)])
@pytest.mark.parametrize("partition_pieces", [200, 100_000])
def test_packing_is_whole_and_certified(spark, low, high, partition_pieces):
    rng = random.Random(low + high)
    lengths = [(i, rng.randint(low, high)) for i in range(600)]
    df = spark.createDataFrame(lengths, "doc_id long, length int")
    out, certificate = pack(df, partition_pieces=partition_pieces)
    rows = out.collect()
    assert in_order([(r["doc_id"], r["length"]) for r in rows]) == in_order(lengths)
    used = check_places(rows, 1024)
    assert used == certificate["sequences"] >= certificate["bound"]
    assert certificate["certified"] == (used == certificate["bound"])
    # Exchanges bring several partitions near what one partition needs.
    alone = best_fit_decreasing(np.array([n for _, n in lengths]), 1024)[0].max() + 1
    assert used <= alone + (0 if partition_pieces > 600 else alone // 40 + 2)
    if partition_pieces > 600 and high <= 200 or low == 1024 or (low, high) == (520, 700):
        assert certificate["certified"]


def test_documents_are_packed_whole(spark):
    pairs = sample()
    rows = packed_documents(documents(spark, pairs), PATH).collect()
    check_places(rows, 1024)
    whole = Tokenizer.from_file(PATH)
    want = []
    for i, t in pairs:
        ids = [*(whole.encode(t, add_special_tokens=False).ids if t else []), 2]
        for k, (at, n) in enumerate(cut(len(ids), 1024)):
            want.append((i, k, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())))
    assert in_order([tuple(r)[:5] for r in rows]) == in_order(want)
    with_ids = token_pieces(documents(spark, pairs), PATH, with_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in with_ids)


def test_empty_table_and_bad_lengths(spark):
    out, certificate = pack(spark.createDataFrame([], "doc_id long, length int"))
    assert got(out, "doc_id") == [] and certificate["sequences"] == certificate["bound"] == 0 and certificate["certified"]
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(1, 1025)], "doc_id long, length int"))
