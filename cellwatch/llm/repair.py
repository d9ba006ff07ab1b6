"""Repair of conversations: the cheapest edits that make the roles take turns.

The roles' initials of a repaired conversation read ``(s?(ua)+)?``. A small
automaton follows them, and a row is kept, given another role, deleted, or gets
new empty rows before it. Working from the end, a vector holds for every state
of the automaton what the rest costs at least. Walking forward from the start,
every step takes the first edit in ASCII order that stays on a cheapest way.

The vectors are not all kept. A part of n rows stores them at about sqrt(n)
checkpoints and recomputes the block behind each checkpoint when the walk
arrives there. Rows are sorted over the whole table, so a long conversation
lies in several parts: a part then gives what it costs from every state to
every state, these are folded from the end to one vector at each part's end,
the parts are walked from every state, and the walks are joined from the start.
Parts see a code for every row, no text. A last pass over the texts, sorted by
conversation and held a row at a time, applies the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cellwatch.session import materialise

# States of the automaton (nothing yet, after s, user's turn over, assistant's turn over).
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
AFTER = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
# The state after a row of the only role, user or assistant, that a state takes from an edit, and that role.
TAKES = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Costs.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NEVER = 1 << 60
# What is left to insert after the last row.
LAST = (0, 4, 2, 0)
BLANK, DUPLICATE, CUT, SOUND = "blank", "duplicate", "truncated", "sound"

_BLANKS = "\\x20\\x09-\\x0D"


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the made-up damage that a checksum of conversation and turn decides; a null is one space.

    Of twenty remainders 0 drops a row, 1 empties its text, 2 removes its stops,
    3 doubles it and 4 makes it the user's.
    """

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rest = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(rest == 1, "").when(rest == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return rows.filter(rest != 0).select(
        "conv_id",
        "turn",
        F.when(rest == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(rest == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _digested(rows: DataFrame) -> DataFrame:
    return rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("digest", F.md5("text"))


_ORDER = ["conv_id", "turn", "role", "digest"]


def _faults(rows: DataFrame) -> DataFrame:
    """One row per distinct row: how often it is there and the fault of the first; later ones are duplicates."""
    bare = F.regexp_replace("text", f"[{_BLANKS}]+$", "")
    ends = F.substring(bare, -1, 1)
    equal = rows.select(
        *_ORDER,
        F.when(bare == "", BLANK).when(ends.isin(".", "!", "?"), SOUND).otherwise(CUT).alias("fault"),
    ).groupBy(*_ORDER).agg(F.count(F.lit(1)).alias("n"), F.min("fault").alias("fault"))
    equal = materialise(equal, "turns")
    # A null turn comes first, so a row whose role and text have one is first nowhere else.
    first = equal.groupBy("conv_id", "role", "digest").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("_known"), F.col("turn").alias("_turn"))).alias("at")
    )
    first = first.select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"),
        F.col("at._turn").alias("_turn"), F.lit(True).alias("_first"),
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("_conv"))
        & F.col("turn").eqNullSafe(F.col("_turn"))
        & (F.col("role") == F.col("_role"))
        & (F.col("digest") == F.col("_digest"))
    )
    marked = equal.join(first, same, "left")
    fault = F.when((F.col("fault") != BLANK) & F.col("_first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    return marked.select(*_ORDER, "n", fault.alias("fault"))


# ---- the automaton over codes: initial and fault of a row, or D for a row that must go ----


def code_of(role: str, fault: str) -> str:
    if fault in (BLANK, DUPLICATE):
        return "D"
    initial = role[:1] if role[:1] in AFTER else "x"
    return initial.upper() if fault == CUT else initial


def _ways(code: str, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a row in ASCII order: letter, cost and state after it. Insertions come before a row and are not here."""
    yield "D", DELETE, state
    if code != "D":
        more, initial = TRUNCATED * code.isupper(), code.lower()
        if state in AFTER.get(initial, {}):
            yield "K", more, AFTER[initial][state]
        yield "R", REROLE + more, TAKES[state]


@lru_cache(1 << 16)
def _back(code: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Least cost of a row and all that follows, by state, from the vector ``after`` the row."""
    here = [min((cost + after[to] for _, cost, to in _ways(code, s)), default=NEVER) for s in STATES]
    for _ in range(3):
        here = [min(here[s], INSERT + here[TAKES[s]]) for s in STATES]
    return tuple(here)


def back(code: str, after: tuple[int, ...]) -> tuple[int, ...]:
    low = min(after)
    return tuple(min(v + low, NEVER) for v in _back(code, tuple(min(a - low, NEVER) for a in after)))


def costs_between(codes: str) -> list[tuple[int, ...]]:
    """For every state at the end the least costs from every state at the start; no insertions after the last row."""
    out = []
    for end in STATES:
        vector = tuple(0 if s == end else NEVER for s in STATES)
        for code in reversed(codes):
            vector = back(code, vector)
        out.append(vector)
    return out


def walk(codes: str, after: tuple[int, ...], state: int, last: bool) -> tuple[str, int, int]:
    """Edits of a part in ASCII-least order, the state behind it, and its least cost to the very end.

    ``after`` is the vector behind the part. Vectors are stored at checkpoints
    sqrt(n) rows apart; the others are recomputed a block at a time.
    """
    n = len(codes)
    step = max(1, isqrt(n))
    kept, vector = {}, after
    for i in range(n - 1, -1, -1):
        if (i + 1) % step == 0 or i == n - 1:
            kept[i + 1] = vector
        vector = back(codes[i], vector)
    total, edits, begin = vector[state], [], 0
    while begin < n:
        end = min(n, (begin // step + 1) * step)
        block = [kept[end]]
        for i in range(end - 1, begin - 1, -1):
            block.append(back(codes[i], block[-1]))
        block.reverse()
        for i in range(begin, end):
            here, following = block[i - begin], block[i - begin + 1]
            while True:
                ways = [(letter, to) for letter, cost, to in _ways(codes[i], state) if cost + following[to] == here[state]]
                if INSERT + here[TAKES[state]] == here[state]:
                    ways.append(("I", TAKES[state]))
                letter, state = min(ways)
                edits.append(letter)
                if letter != "I":
                    break
        begin = end
    while last and LAST[state]:
        edits.append("I")
        state = TAKES[state]
    return "".join(edits), state, total


# ---- parts: runs of one conversation inside a range of the sorted table ----

_PART = (
    "conv_id {id}, part int, turn {turn}, role string, digest string, codes binary, first string, last string, "
    "illegal long, blank long, duplicate long, truncated long, low {turn}, high {turn}, n_turns long"
)


class _Part:
    """What one pass over the rows of a part notes down: a code per row, counts and ends."""

    def __init__(self, conv, part, turn, role, digest):
        self.key = (conv, part, turn, role, digest)
        self.codes, self.first, self.last = bytearray(), role[:1], None
        self.illegal, self.counts = 0, {BLANK: 0, DUPLICATE: 0, CUT: 0, SOUND: 0}
        self.low = self.high = None
        self.n_turns = 0

    def add(self, turn, role, n, fault):
        initial = role[:1]
        if self.last is not None:
            self.illegal += not legal(self.last, initial)
        self.illegal += (n - 1) * (not legal(initial, initial))
        self.last = initial
        self.codes += code_of(role, fault).encode()
        self.counts[fault] += 1
        self.counts[BLANK if fault == BLANK else DUPLICATE] += n - 1
        self.codes += b"D" * (n - 1)
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.n_turns = turn, self.n_turns + 1

    def row(self):
        c = self.counts
        return (*self.key, bytes(self.codes), self.first, self.last, self.illegal, c[BLANK], c[DUPLICATE], c[CUT],
                self.low, self.high, self.n_turns)


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


_CHUNK = 2000


def _arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _batch(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*out)))), schema=schema)


def _records(batches: Iterable, columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns])


def _parts(rows: DataFrame) -> DataFrame:
    """One row per conversation and range: its codes and counts."""
    kinds = dict(rows.dtypes)
    names = [*_ORDER, "n", "fault"]

    def note(batches):
        part, open_, done = TaskContext.get().partitionId(), None, []
        for conv, turn, role, digest, n, fault in _records(batches, names):
            if open_ is None or open_.key[0] != conv:
                if open_ is not None:
                    done.append(open_.row())
                open_ = _Part(conv, part, turn, role, digest)
            open_.add(turn, role, n, fault)
            if len(done) >= _CHUNK:
                yield _batch(done, schema)
                done = []
        if open_ is not None:
            done.append(open_.row())
        if done:
            yield _batch(done, schema)

    ddl = _PART.format(id=kinds["conv_id"], turn=kinds["turn"])
    schema = _arrow_schema(ddl)
    dealt = rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    return materialise(dealt.mapInArrow(note, ddl), "parts")


_WALKS = "conv_id {id}, part int, starts array<int>, edits array<string>, ends array<int>, costs array<long>"


def _folded(parts: DataFrame) -> DataFrame:
    """conv_id, part and ``edits`` of every part, joined over the parts of long conversations; ``cost`` at the first part.

    Only the parts of one conversation meet in a group, one row for each range
    of the sort that it touches; their codes stay out of it.
    """
    kind = dict(parts.dtypes)["conv_id"]
    shared = parts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.join(shared.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    @F.udf("struct<edits: string, cost: long>")
    def alone(codes):
        edits, _, cost = walk(codes.decode(), LAST, START, True)
        return edits, cost

    single = parts.filter("_n = 1").withColumn("w", alone("codes")).select(
        "conv_id", "part", F.col("w.edits").alias("edits"), F.col("w.cost").alias("cost")
    )

    @F.udf("array<array<long>>")
    def between(codes):
        return [list(v) for v in costs_between(codes.decode())]

    long = parts.filter("_n > 1")
    costs = materialise(long.select("conv_id", "part", between("codes").alias("between")), "part-costs")

    def from_the_end(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part", ascending=False)
        after, vectors = LAST, []
        for m in group["between"]:
            vectors.append([int(v) for v in after])
            after = [min(NEVER, min(int(m[e][s]) + after[e] for e in STATES)) for s in STATES]
            after = [min(after[s], INSERT + after[TAKES[s]]) for s in STATES]
        return pd.DataFrame({"conv_id": group["conv_id"], "part": group["part"], "after": vectors})

    after = costs.groupBy("conv_id").applyInPandas(from_the_end, f"conv_id {kind}, part int, after array<long>")
    after = after.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "after")

    @F.udf("struct<edits: array<string>, ends: array<int>, costs: array<long>>")
    def walked(codes, after, ends):
        ways = [walk(codes.decode(), tuple(after), s, ends) for s in STATES]
        return [w[0] for w in ways], [w[1] for w in ways], [w[2] for w in ways]

    final = long.groupBy("conv_id").agg(F.max("part").alias("_final")).withColumnRenamed("conv_id", "_conv2")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    ways = (
        long.join(after, same)
        .join(final, F.col("conv_id").eqNullSafe(F.col("_conv2")))
        .select("conv_id", "part", walked("codes", "after", F.col("part") == F.col("_final")).alias("w"))
    )
    ways = materialise(ways.select("conv_id", "part", "w.*"), "part-walks")

    def from_the_start(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        state, begins = START, []
        for ends in group["ends"]:
            begins.append(state)
            state = int(ends[state])
        return pd.DataFrame({"conv_id": group["conv_id"], "part": group["part"], "begin": begins})

    begins = ways.select("conv_id", "part", "ends").groupBy("conv_id").applyInPandas(
        from_the_start, f"conv_id {kind}, part int, begin int"
    )
    begins = begins.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "begin")
    chosen = ways.join(begins, same).select(
        "conv_id", "part", F.get("edits", "begin").alias("edits"), F.get("costs", "begin").alias("cost")
    )
    return single.unionByName(chosen)


class _Applied:
    """Applies a conversation's edits to its rows as they come by."""

    def __init__(self):
        self.edits, self.at, self.state = "", 0, START

    def more(self, edits: str):
        self.edits, self.at = self.edits[self.at :] + edits, 0

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.edits[self.at : self.at + 1] == "I":
            self.state, self.at = TAKES[self.state], self.at + 1
            yield "I", ROLES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        letter = self.edits[self.at]
        self.at += 1
        if letter == "K":
            self.state = AFTER[role[:1]][self.state]
        elif letter == "R":
            self.state = TAKES[self.state]
            role = ROLES[self.state]
        yield letter, role, text


def _with_edits(rows: DataFrame, parts: DataFrame, edits: DataFrame) -> DataFrame:
    """Rows and, before the first row of each part, its edits; sorted by conversation and order in every partition."""
    at = parts.select("conv_id", "part", "turn", "role", "digest").join(
        edits.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "edits"),
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")),
    )
    both = rows.select(*_ORDER, "text", F.lit(1).alias("tag")).unionByName(
        at.select(*_ORDER, F.col("edits").alias("text"), F.lit(0).alias("tag"))
    )
    return both.repartition("conv_id").sortWithinPartitions(*_ORDER, "tag")


def _stream(batches: Iterable) -> Iterator[tuple]:
    """conversation and its repaired rows (letter, role, text), one conversation after another; None ends one."""
    now, current = None, object()
    for conv, role, text, tag in _records(batches, ["conv_id", "role", "text", "tag"]):
        if now is None or conv != current:
            if now is not None:
                yield from ((current, r) for r in now.inserted())
                yield current, None
            now, current = _Applied(), conv
        if tag == 0:
            now.more(text)
        else:
            yield from ((conv, r) for r in now.row(role, text))
    if now is not None:
        yield from ((current, r) for r in now.inserted())
        yield current, None


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place, edit, role and text of every row of the repaired conversations, deleted rows among them.

    Places count from 0 within a conversation; rows with edit ``D`` are gone
    from it, rows with edit ``I`` are new and empty.
    """
    rows = _digested(rows)
    parts = _parts(_faults(rows))
    kind = dict(rows.dtypes)["conv_id"]

    ddl = f"conv_id {kind}, place long, edit string, role string, text string"
    schema = _arrow_schema(ddl)

    def apply(batches):
        out, place = [], 0
        for conv, row in _stream(batches):
            if row is None:
                place = 0
                continue
            out.append((conv, place, *row))
            place += 1
            if len(out) >= _CHUNK:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return _with_edits(rows, parts, _folded(parts)).mapInArrow(apply, ddl)


def repairs(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation: gaps, faults, illegal neighbours, cost, audit and the hash of the repaired text.

    ``rows`` has conv_id, turn, role and text; a null role or text is one space
    and other columns are left out. Rows of a conversation are taken by turn,
    null turns first, rows of one turn by role and the digest of their text, so
    equal rows follow each other. A row of another role than those of the
    automaton can only be deleted or given a role. ``ids`` lists conversations
    that are returned even without rows: with zeros, an empty audit and the
    hash of the empty text. A null conv_id is a conversation like any other.

    The hash of a conversation is one stream through one task, since SHA-256 has
    no parts; it holds a row and the edits at a time.
    """
    rows = _digested(rows)
    kind = dict(rows.dtypes)["conv_id"]
    parts = _parts(_faults(rows))
    edits = materialise(_folded(parts), "edits")
    ddl = f"conv_id {kind}, repaired_sha256 string"
    schema = _arrow_schema(ddl)

    def hashes(batches):
        out, state, empty = [], hashlib.sha256(), True
        for conv, row in _stream(batches):
            if row is None:
                out.append((conv, state.hexdigest()))
                state, empty = hashlib.sha256(), True
                if len(out) >= _CHUNK:
                    yield _batch(out, schema)
                    out = []
            elif row[0] != "D":
                state.update(("" if empty else "\n").encode() + f"{row[1]}:{row[2]}".encode())
                empty = False
        if out:
            yield _batch(out, schema)

    hashed = _with_edits(rows, parts, edits).mapInArrow(hashes, ddl)

    # Neighbouring parts of one conversation: the rows and turns that meet there.
    light = parts.drop("codes", "turn", "role", "digest").join(
        edits.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "edits", "cost"),
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")),
    )
    item = F.struct("part", "first", "last", "illegal", "blank", "duplicate", "truncated", "low", "high", "n_turns", "edits", "cost")
    grouped = light.groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("p"))

    def total(c: str) -> str:
        return f"aggregate(p, 0L, (t, x) -> t + x.{c})"

    pairs = "transform(sequence(1, size(p) - 1), i -> {})"

    def between(expr: str) -> str:
        return f"if(size(p) > 1, aggregate({pairs.format(expr)}, 0L, (t, x) -> t + x), 0L)"

    ends = "concat(p[i - 1].last, p[i].first)"
    met = between(f"if({ends} IN ('su', 'ua', 'au'), 0L, 1L)")
    twice = between("if(p[i - 1].high = p[i].low, 1L, 0L)")
    counts = grouped.selectExpr(
        "conv_id",
        f"coalesce(array_max(p.high) - array_min(p.low) + 1 - ({total('n_turns')} - {twice}), 0L) AS gaps",
        f"{total('blank')} AS blank",
        f"{total('duplicate')} AS duplicate",
        f"{total('truncated')} AS truncated",
        f"{total('illegal')} + {met} AS illegal",
        "p[0].cost AS cost",
        "array_join(p.edits, '') AS audit",
    )
    found = counts.join(hashed.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    if ids is None:
        return found
    asked = ids.select(F.col("conv_id").alias("_id")).distinct()
    joined = asked.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    zeros = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        F.col("_id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in zeros],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
