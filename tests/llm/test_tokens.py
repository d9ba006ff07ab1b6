import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cellwatch.llm.planes import PlaneReader, PlaneWriter, from_planes, read_documents, to_planes, write_ids
from cellwatch.llm.queries import tokenizer_file
from cellwatch.llm.tokens import encoded
from cellwatch.session import scratch_path
from tests.llm.data import documents, got, in_order
from tests.llm.data import rows as sample

PATH = tokenizer_file()
WHOLE = Tokenizer.from_file(PATH)
ODD = [" ", "  ", "\n", "\t", "\r\n", "'s", "'", "a", "Bc", "é", "²", "1", "!", "\x1c", "\x85", "\xa0", "\u2003", "\u200b", "日", "\U0001f600"]
ODD += ["<|endoftext|>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=14).map("".join) | st.text(max_size=40))
def test_pieces_give_the_ids_of_the_whole_text(text):
    want = WHOLE.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(one(text), "<u4").tolist() == want


def one(text):
    return next(encoded(PATH, [text]))


def test_many_texts_come_in_order():
    rng = random.Random(7)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(30))) + "x" * rng.choice([0, 0, 100]) for _ in range(500)]
    want = [WHOLE.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoded(PATH, texts)] == want


def test_null_text_has_no_ids():
    assert list(encoded(PATH, [None, "", None])) == [b"", b"", b""]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
        planes = to_planes(ids, kind)
        assert len(planes) == (4 if kind == "byte" else 32)
        assert (from_planes(planes, n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_file_round_trip(kind, tmp_path):
    rng = random.Random(4)
    docs = [(i if i % 5 else None, np.array([rng.randrange(50_257) for _ in range(rng.choice([0, 1, 3, 200]))], "<u4").tobytes()) for i in range(50)]
    path = tmp_path / "a.ids"
    with open(path, "wb") as f:
        writer = PlaneWriter(f, kind, block_ids=64)
        for d in docs:
            writer.add(*d)
        total = writer.close()
    with open(path, "rb") as f:
        reader = PlaneReader(f)
        assert [(i, b) for i, _, b in reader.documents()] == docs
        assert sum(b[0] for b in reader.blocks) == total and all(b[0] <= 64 for b in reader.blocks)
    path.write_bytes(b"IDPLANE1" + b"0" * 40)
    with open(path, "rb") as f, pytest.raises(ValueError):
        PlaneReader(f)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_written_files_read_back(spark, kind):
    pairs = sample()
    files = write_ids(documents(spark, pairs), scratch_path(spark, "ids"), PATH, kind=kind, block_ids=1000)
    found = read_documents(spark, files).collect()
    assert sum(f["n_docs"] for f in files) == len(pairs)
    want = []
    for i, t in pairs:
        ids = np.array([*(WHOLE.encode(t, add_special_tokens=False).ids if t else []), 0], "<u4").tobytes()
        want.append((i, len(ids) // 4, zlib.crc32(ids)))
    assert in_order([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found]) == in_order(want)
    ordered = sorted(found, key=lambda r: r["start"])
    at = 0
    for r in ordered:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_empty_table_gives_no_files(spark):
    files = write_ids(documents(spark).limit(0), scratch_path(spark, "ids"), PATH)
    assert files == [] and got(read_documents(spark, files), "doc_id") == []


def test_each_distinct_piece_of_many_texts_is_looked_up_once():
    from cellwatch.llm.tokens import _Encoder

    class Counting(dict):
        asked = 0

        def __getitem__(self, piece):
            Counting.asked += 1
            return dict.__getitem__(self, piece)

    encoder = _Encoder(PATH)
    encoder.known = Counting()
    texts = ["é one two\none two\x00three  é\xa0 one"] * 200
    want = np.array(WHOLE.encode(texts[0], add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.many(texts) == [want] * 200 and Counting.asked < 20
