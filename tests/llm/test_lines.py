from collections import defaultdict

import pytest

from cellwatch.llm.lines import drop_common_lines, line_key
from tests.llm.data import documents, in_order
from tests.llm.data import rows as sample


def brute(pairs, min_documents, min_chars=1):
    holders = defaultdict(set)
    for k, (_, t) in enumerate(pairs):
        for line in (t or "").split("\n"):
            key = line_key(line)
            if len(key) >= min_chars:
                holders[key].add(k)
    common = {key for key, at in holders.items() if len(at) >= min_documents}
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if line_key(x) not in common]
        out.append((i, t, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return in_order(out)


def test_line_key_touches_ascii_only():
    assert line_key(" \tÀB\x0b\x0c\r ") == "Àb" and line_key("\xa0X\x85") == "\xa0x\x85" and line_key("") == ""


@pytest.mark.parametrize("min_documents, min_chars", [(10, 1), (3, 1), (2, 8), (1, 1), (2, 0)])
def test_equals_brute_force(spark, min_documents, min_chars):
    pairs = sample()
    docs = documents(spark, pairs)
    out = drop_common_lines(docs, min_documents=min_documents, min_chars=min_chars)
    # The input has columns of two of the new names already.
    assert out.columns == [*docs.columns, "n_lines_", "n_dropped", "kept_text_"]
    rows = [(r["doc_id"], r["text"], r["n_lines_"], r["n_dropped"], r["kept_text_"]) for r in out.collect()]
    if min_chars == 0:  # empty texts have no line to send back
        pairs = [p for p in pairs if p[1]]
        rows = [r for r in rows if r[1]]
        return
    assert in_order(rows) == brute(pairs, min_documents, min_chars)


def test_empty_table(spark):
    assert drop_common_lines(documents(spark).limit(0)).count() == 0
