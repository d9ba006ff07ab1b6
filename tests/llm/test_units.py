import random
import re

from cellwatch.llm.units import repeated_units, units, without_spans
from tests.llm.data import documents, got


def passage(seed, sentences=8):
    rng = random.Random(seed)
    return " ".join(" ".join(f"p{seed}q{rng.randrange(10**6)}" for _ in range(12)) + "." for _ in range(sentences))


def test_units_of_a_text():
    text = "One two three four five six seven eight. Nine ten!\n\nshort line\n" + "a b c d e f g h i"
    found = [(text[a:b], n) for a, b, n, _ in units(text)]
    assert found == [
        ("One two three four five six seven eight.", 8),
        ("One two three four five six seven eight. Nine ten!", 10),
        ("a b c d e f g h i", 9),
    ]
    assert units(None) == [] and units("") == [] and units("a b") == []
    assert units("A, b; C d e f g\th")[0][3] == units("a b c d e f g h")[0][3]


PASSAGE = passage(1)
DOCS = [
    (1, passage(11) + "\n" + PASSAGE + "\n" + passage(12)),
    (2, passage(13) + "\n" + PASSAGE.upper() + "\n" + passage(14)),
    (3, passage(15) + " In the middle " + PASSAGE + " " + passage(16)),
    (4, passage(17)),
    (5, PASSAGE + "\n" + PASSAGE),
    (6, None),
    (7, ""),
    (8, "x y"),
    (4, passage(17)),
    (None, PASSAGE),
]


def test_all_but_the_first_occurrence(spark):
    found = repeated_units(documents(spark, DOCS)).collect()
    texts = dict(reversed([d for d in DOCS]))
    assert {r["doc_id"] for r in found} == {2, 3, 5, None}
    assert {r["kept_doc_id"] for r in found} == {1}
    for r in found:
        cut, kept = texts[r["doc_id"]][r["begin"] : r["end"]], texts[1][r["kept_begin"] :]
        words = re.findall(r"\w+", cut.lower())
        assert len(words) == r["n_words"] and re.findall(r"\w+", kept.lower())[: len(words)] == words
    # Document 3 has the passage inside a line: all its sentences but the first, which has other words before it.
    gone = {(r["begin"], r["end"]) for r in found if r["doc_id"] == 3}
    assert len(gone) == 7
    # The line as a whole and its sentences, twice in document 5.
    assert sum(1 for r in found if r["doc_id"] == 5) == 2 * 9


def test_removal_keeps_original_offsets(spark):
    docs = documents(spark, DOCS)
    out = without_spans(docs, repeated_units(docs)).collect()
    assert len(out) == len(DOCS)
    for r in out:
        text = r["text"] or ""
        spans = [(s["begin"], s["end"]) for s in r[-2]]
        assert "".join(text[a:b] for a, b in spans) == r[-1]
        assert all(a < b <= c for (a, b), (c, _) in zip(spans, spans[1:]))
        if r["doc_id"] in (1, 4):
            assert r[-1] == text
        if r["doc_id"] == 5:
            assert r[-1].strip() == ""
        if r["doc_id"] == 2:
            assert r[-1] == text.replace(PASSAGE.upper(), "")


def test_short_runs_are_left_alone(spark):
    line = "Every page of this site ends with this line of words."
    long = passage(30, 3)
    pairs = [(i, f"{passage(40 + i, 3)}\n{line}\n{passage(60 + i, 2)}" + (f"\n{line}\n{long}" if i > 3 else "")) for i in range(6)]
    found = repeated_units(documents(spark, pairs))
    # The line next to a passage is one run with it, the line alone is not.
    assert {r["doc_id"] for r in found.collect()} == {5}
    every = repeated_units(documents(spark, pairs), min_run_words=0)
    assert {r["doc_id"] for r in every.collect()} == {1, 2, 3, 4, 5}


def test_awkward_rows_and_empty_table(spark):
    assert repeated_units(documents(spark)).count() > 0
    assert repeated_units(documents(spark).limit(0)).count() == 0
    assert got(repeated_units(documents(spark, [(1, None), (None, "a")])), "doc_id") == []


def test_one_sentence_of_a_long_passage_is_enough(spark):
    words = [f"v{i}" for i in range(58)]
    words[22], words[34] = "v22.", "v34."
    inner = " ".join(words)
    pairs = [(1, f"{passage(70, 1)} Before it {inner} after it."), (2, f"{passage(71, 1)} Other words {inner} and more.")]
    found = [tuple(r) for r in repeated_units(documents(spark, pairs)).select("doc_id", "begin", "end", "n_words").collect()]
    (doc, begin, end, n), = found
    assert (doc, n) == (2, 12) and pairs[1][1][begin:end] == " ".join(words[23:35])
