import re

import pytest

from cellwatch.llm import rules
from tests.llm.data import documents, got, in_order
from tests.llm.data import rows as sample


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen, covered = {}, set()
    for i, v in enumerate(windows):
        seen.setdefault(v, []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered.update(p for i in at for p in range(i, i + 8))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


TEXTS = [
    *sample(),
    (100, "a b c d e f g h " * 5),
    (101, " ".join(f"x{i}" for i in range(40)) + " " + " ".join(f"x{i}" for i in range(3, 30))),
    (102, "a " * 8),
    (103, "a " * 9),
    (104, "dup\ndup\n dup\n\n \ndup"),
    (105, "# * $ % & | < > plain !! \x85 \xa0 x"),
]


def test_measures_equal_brute_force(spark):
    found = rules.measure(documents(spark, TEXTS))
    want = in_order([(i, *brute(t)) for i, t in TEXTS])
    assert got(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == want


def test_bits_policies_and_ablation(spark):
    rows = rules.ledger(documents(spark, TEXTS)).cache()
    total = rows.count()
    assert total == len(TEXTS)
    bits = [r["failures"] for r in rows.collect()]
    for policy in (rules.BASE, rules.STANDARD):
        own = rules.mask(policy)
        by_rule = {r["rule"]: r for r in rules.ablation(rows, policy).collect()}
        assert set(by_rule) == set(policy.rules)
        kept = rows.filter(~rules.fails(policy)).count()
        assert kept == sum(1 for b in bits if not b & own)
        for rule in rules.RULES:
            if rule.name in policy.rules:
                r = by_rule[rule.name]
                assert r["n_failing"] == sum(1 for b in bits if b >> rule.bit & 1)
                assert r["n_only_this"] == sum(1 for b in bits if b & own == 1 << rule.bit)
                assert r["n_kept_without"] == sum(1 for b in bits if not b & own & ~(1 << rule.bit))


def test_clean_prose_is_kept_and_junk_is_not(spark):
    clean = " ".join(f"Word{i} and" for i in range(60)) + "."
    junk = ["A!! B!! " * 30, " ".join(f"x{i}### y{i}%%%" for i in range(30)), "SHOUTING " + " ".join(f"WORD{i}" for i in range(40))]
    rows = rules.ledger(documents(spark, [(0, clean), *enumerate(junk, 1)]))
    assert got(rows.filter(~rules.fails(rules.STANDARD)), "doc_id") == [(0,)]


def test_empty_table_and_shared_bits(spark):
    assert rules.ledger(documents(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        rules.ledger(documents(spark), [rules.RULES[0], rules.RULES[0]])


def test_no_python_in_the_plan(spark):
    plan = rules.ledger(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("== Physical Plan ==")[1]
