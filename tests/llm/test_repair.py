import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cellwatch.llm import repair

BLANKS = " \t\n\x0b\x0c\r"
LAYOUT = "conv_id long, turn long, role string, text string, digest string, part int"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_s, turn_s = (" " if v is None else str(v) for v in (conv, turn))
        h = zlib.crc32(f"{conv_s}:{turn_s}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if h == 1:
            text = ""
        elif h == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif h == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) by keeping the best (cost, audit) of every way from each place; full strings, no tables of vectors."""
    from functools import lru_cache

    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.rstrip(BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, state, inserted):
        ways = []
        if i == len(rows):
            if state in ("", "a"):
                ways.append((0, "", ()))
        else:
            role, text, fault = rows[i][2], rows[i][3], faults[i]
            c, a, t = best(i + 1, state, 0)
            ways.append((c + 3, "D" + a, t))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (state, role[:1]) in after:
                    c, a, t = best(i + 1, after[state, role[:1]], 0)
                    ways.append((c + more, "K" + a, (f"{role}:{text}", t)))
                for new in ("user", "assistant"):
                    if (state, new[0]) in after:
                        c, a, t = best(i + 1, new[0], 0)
                        ways.append((c + 2 + more, "R" + a, (f"{new}:{text}", t)))
        if inserted < 3:
            for new in ("user", "assistant"):
                if (state, new[0]) in after:
                    c, a, t = best(i, new[0], inserted + 1)
                    ways.append((c + 2, "I" + a, (f"{new}:", t)))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    cost, audit, chain = best(0, "", 0)
    lines = []
    while chain:
        line, chain = chain
        lines.append(line)
    return cost, audit, lines, faults


def brute(rows, ids):
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append(r)
    out = []
    for conv in ids:
        mine = by_conv.get(conv, [])
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        cost, audit, lines, faults = cheapest(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def conversations(seed, sizes):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", " \n", "", "A longer line\nof text!", "é.", None, "Well. "]
    rows = []
    for conv, n in enumerate(sizes):
        for _ in range(n):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "u", "Sam", "S"])
            turn = rng.choice([None, *range(n)]) if rng.random() < 0.4 else rng.randrange(n * 2)
            text = rng.choice(texts) if rng.random() < 0.6 else f"{rng.randrange(10**6)}{rng.choice('.!? x')}"
            rows.append((conv if conv else None, turn, role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], LAYOUT)


def found(spark, rows, spread=None):
    given = frame(spark, rows)
    out = repair.repairs(repair.damaged(given), given.select("conv_id"))
    return sorted((tuple(r) for r in out.select(COLUMNS).collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_repairs_equal_brute_force(spark, seed):
    rows = conversations(seed, [9, *range(1, 25)] * (seed + 1))
    assert found(spark, rows) == brute(damage(rows), {r[0] for r in rows})


def test_conversations_over_several_parts(spark):
    rows = conversations(7, [3, 60, 2, 90])
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        faults = repair._faults(repair._digested(repair.damaged(frame(spark, rows))))
        parts = repair._parts(faults).groupBy("conv_id").count().agg(F.max("count")).first()[0]
        assert parts > 2
        assert found(spark, rows) == brute(damage(rows), {r[0] for r in rows})
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_parts_join_to_the_whole_walk():
    rng = random.Random(2)
    for _ in range(300):
        codes = "".join(rng.choice("suaxSUAXD") for _ in range(rng.randrange(1, 30)))
        cut = rng.randrange(len(codes) + 1)
        whole, state, cost = repair.walk(codes, repair.LAST, repair.START, True)
        between = repair.costs_between(codes[cut:])
        after = tuple(min(between[e][s] + repair.LAST[e] for e in repair.STATES) for s in repair.STATES)
        a, middle, first = repair.walk(codes[:cut], after, repair.START, False)
        b, end, _ = repair.walk(codes[cut:], repair.LAST, middle, True)
        # Insertions between the parts belong to the second one.
        assert (a + b, end, first) == (whole, state, cost)
        assert cost == min(repair.costs_between(codes)[e][repair.START] + repair.LAST[e] for e in repair.STATES)


def test_repaired_rows_read_as_the_hash_says(spark):
    rows = repair.damaged(frame(spark, conversations(5, [4, 6, 9, 14])))
    lines = {}
    for r in repair.repaired(rows).sort("conv_id", "place").collect():
        if r["edit"] != "D":
            lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in repair.repairs(rows).collect()}
    assert {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in lines.items()} == {
        c: h for c, h in hashes.items() if c in lines
    }
    for x in lines.values():
        roles = "".join(line[0] for line in x)
        assert roles.removeprefix("s") == "ua" * (len(roles.removeprefix("s")) // 2) and roles != "s"


def test_awkward_rows(spark):
    empty = frame(spark, [])
    assert repair.repairs(repair.damaged(empty), empty.select("conv_id")).count() == 0
    long = [(1, 0, "user", "x " * 200_000 + "."), (1, 1, "assistant", "fine."), (2, None, None, None)]
    assert found(spark, long) == brute(damage(long), {1, 2})
    same = [(3, 5, "user", "again.")] * 300
    out = repair.repairs(frame(spark, same)).collect()[0]
    assert (out["duplicate"], out["illegal"], out["cost"]) == (299, 299, 299 * 3 + 2)
    missing = repair.repairs(frame(spark, same), spark.createDataFrame([(9,)], "conv_id long")).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in missing] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
