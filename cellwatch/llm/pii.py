"""Personal data in texts: fixed patterns first, and what boosted trees add to them.

The fixed patterns find e-mail addresses, IP addresses, card and phone numbers
as they are normally written. Generators with few demands propose further
spans, which may overlap: addresses with a spelled or bracketed ``at`` and
``dot``, and every row of digit groups that has a fitting number of digits.
Boosted trees score each proposal from its form and its surroundings, and
thresholds calibrated on rows held out of the fit decide. Of the accepted spans
those of higher score win; spans of the fixed patterns always stay.

Nobody labelled spans, so examples are made from all documents: a span of the
fixed patterns is one to find, also after it has been rewritten the way people
hide or group such data, in its own surroundings; damaged rewritings (a wrong
check digit, parts over 255), spans that cover only a part, and everything else
that the generators propose are not.

The fit counts every example. Spark counts equal ones, and every level of a tree
is one job that sums gradients by node, feature and bin, so the driver holds
sums of fixed size and no example.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.frames import materialise

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# One in so many parts of the documents is held out of the trees, for the thresholds.
HELD_OUT = 3
PRECISION = 0.95
AROUND = 60

# ---- fixed patterns ----

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Parts of digits cannot start in the middle of a row of digits, nor end there.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(d // 10 + d % 10 for d in doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) of the fixed patterns, leftmost and not overlapping within a kind."""
    found = [(EMAIL, *s) for s in _emails(text)]
    found += [(IP, *m.span()) for m in _IP.finditer(text) if all(map(_octet, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            found.append((CARD, *m.span()))
    found += [(PHONE, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return found


# ---- proposals ----

_ANCHOR = re.compile(r"@|[\[({<] ?(?:at|AT) ?[\])}>]|\s(?:dot|DOT)\s")
_AT = r"(?: {0,2}@ {0,2}| ?[\[({<] ?(?:at|AT|@) ?[\])}>] ?|\s(?:at|AT)\s)"
_DOT = r"(?: ?\. ?| ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?|\s(?:dot|DOT)\s)"
_HIDDEN = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]{{0,63}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}"
)
_NUMBERS = re.compile(r"[0-9][0-9 ().\-_/\[\]]*[0-9]")
_GROUP = re.compile(r"[0-9]+")
# Card and phone numbers have no more groups than this, and a single digit only as their first.
MAX_GROUPS = 7
_OPENING = re.compile(r"(?:\+|\b00)? ?\(?$")
# Endings of addresses that are common.
_TLDS = frozenset("com org net edu gov io de fr es it uk eu info biz co us".split())
# Words that announce a kind.
_CUES = (
    re.compile(r"mail|e-mail|contact|write to", re.I),
    re.compile(r"\bip\b|host|server|address|ping", re.I),
    re.compile(r"card|visa|master|credit|pay", re.I),
    re.compile(r"tel|phone|call|mobile|fax|cell", re.I),
)
_NOT_CUES = re.compile(r"version|\bv$|isbn|order|id\b|#$|\bno\b|date", re.I)


def _groups(text: str) -> Iterator[list[tuple[int, int]]]:
    """Rows of digit groups that at most three other characters separate."""
    for m in _NUMBERS.finditer(text):
        row, last = [], None
        for g in _GROUP.finditer(text, m.start(), m.end()):
            if last is not None and g.start() - last > 3:
                yield row
                row = []
            row.append(g.span())
            last = g.end()
        yield row


def proposals(text: str) -> list[Span]:
    """Spans that might be personal data; they overlap, and all of a row of groups are listed."""
    found = set()
    last = -1
    for a in _ANCHOR.finditer(text):
        if a.start() < last:
            continue
        low, high = max(0, a.start() - 200), min(len(text), a.end() + 300)
        for m in _HIDDEN.finditer(text[low:high]):
            found.add((EMAIL, low + m.start(), low + m.end()))
        last = a.start() + 100
    for row in _groups(text):
        sizes = [e - s for s, e in row]
        for i in range(len(row)):
            total = 0
            for j in range(i, min(len(row), i + MAX_GROUPS)):
                total += sizes[j]
                if total > 19:
                    break
                start, end, n = row[i][0], row[j][1], j - i + 1
                if n == 4 and max(sizes[i : j + 1]) <= 3:
                    found.add((IP, start, end))
                if j > i and 1 in sizes[i + 1 : j + 1]:
                    continue
                if total >= 13:
                    found.add((CARD, start, end))
                if 7 <= total <= 15:
                    opening = _OPENING.search(text, max(0, start - 4), start)
                    found.add((PHONE, opening.start() if opening else start, end))
    return sorted(found)


FEATURES = (
    "email ip card phone digits length groups longest_group shortest_group separators luhn octets zero_group plus paren "
    "first_group last_group before after at hidden_at hidden_dot tld local_digit spaces cue counter_cue digits_around "
    "number_before number_after first_digit even_groups"
).split()


def _class(c: str) -> int:
    if not c:
        return 0
    if c.isspace():
        return 1
    if "0" <= c <= "9":
        return 2
    if c.isalpha():
        return 3
    return 4 if c in "\"'=:#_/-+.@" else 5


def features(text: str, span: Span) -> list[float]:
    """Form of a span and what stands around it."""
    kind, start, end = span
    s = text[start:end]
    left, right = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    groups = _GROUP.findall(s)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    inner = re.sub(r"[0-9A-Za-z]", "", s)
    around = left + right
    label = re.search(r"[A-Za-z0-9-]+$", s)
    return [
        *[float(kind == k) for k in range(4)],
        len(digits), end - start, len(groups), max(sizes), min(sizes), len(set(inner)),
        bool(digits) and luhn(digits), len(groups) == 4 and all(map(_octet, groups)),
        any(len(g) > 1 and g[0] == "0" for g in groups), "+" in s, "(" in s, sizes[0], sizes[-1],
        _class(text[start - 1 : start]), _class(text[end : end + 1]), "@" in s,
        bool(re.search(r"[\[({<] ?(?:at|AT|@)", s)), bool(re.search(r"[\[({<] ?(?:dot|DOT|\.)", s)),
        bool(label) and label.group().lower() in _TLDS, bool(re.match(r"[^@\s]*[0-9]", s)), s.count(" "),
        bool(_CUES[kind].search(left)), bool(_NOT_CUES.search(left[-12:])),
        sum("0" <= c <= "9" for c in around) / max(1, len(around)),
        bool(re.search(r"[0-9][ ().\-_/]{0,3}$", left)), bool(re.match(r"[ ().\-_/]{0,3}[0-9]", right)),
        float(digits[0]) if digits else -1, len(set(sizes[:-1])) <= 1,
    ]


_CHUNK = 5000


def _marked(text: str, spans_: list[Span]) -> bytearray:
    """A byte per code point, 1 where one of the spans is."""
    marks = bytearray(len(text))
    for _, start, end in spans_:
        marks[start:end] = b"\1" * (end - start)
    return marks


# ---- examples ----


def _rewritten(kind: int, s: str) -> list[tuple[str, bool]]:
    """The span as people hide or group it, and damaged, which is not personal data any more."""
    if kind == EMAIL:
        name, _, host = s.partition("@")
        spelled = host.replace(".", " dot ")
        return [
            (f"{name} at {spelled}", True), (f"{name} [at] {host.replace('.', ' [dot] ')}", True),
            (f"{name}(at){host}", True), (f"{name} @ {host}", True), (f"{name}[at]{host.replace('.', '[.]')}", True),
            (f"{name} @ {host.split('.')[0]}. {name.capitalize()}", False), (f"{name}@{host.split('.')[0]}. {name}", False),
            (f"{name} at {host.split('.')[0]} dot {name}", False), (f"{name} (at) {host.split('.')[0]}. {name}", False),
        ]
    if kind == IP:
        p = s.split(".")
        return [
            ("[.]".join(p), True), (" . ".join(p), True), ("(.)".join(p), True),
            (".".join([*p[:3], str(256 + int(p[3][-3:]))]), False), ("-".join(p), False), (" ".join(p), False),
        ]
    if kind == CARD:
        d = _digits(s)
        four = [d[i : i + 4] for i in range(0, len(d), 4)]
        wrong = d[:-1] + str((int(d[-1]) + 1) % 10)
        return [
            (".".join(four), True), ("/".join(four), True), ("_".join(four), True), (" ".join(four), True), ("-".join(four), True),
            (d, True), (wrong, False), (" ".join(wrong[i : i + 4] for i in range(0, len(d), 4)), False),
            (" ".join(d[i : i + 3] for i in range(0, len(d), 3)), False),
        ]
    d = _digits(s)
    local = d[-10:] if len(d) > 10 else d
    return [
        (f"({local[:3]}) {local[3:6]}-{local[6:]}", True), (f"{local[:3]}-{local[3:6]}-{local[6:]}", True),
        (f"{local[:3]}.{local[3:6]}.{local[6:]}", True), (f"00{d[0]} {local[:3]} {local[3:6]} {local[6:]}", True),
        (f"+{d}", True), (d, False), (f"{local[:3]}, {local[3:]}", False), (f"{local[:4]}-{local[4:6]}-{local[6:8]}", False),
    ]


# Other numbers that data may stand beside.
_BESIDE = (("", " 190.37.223.204"), ("7536784127813050 ", ""), ("12 ", " 2024"))


def examples(text: str) -> Iterator[tuple[list[float], int]]:
    """Features and 0 or 1 of every proposal in a text and in its rewritten spans."""
    base = base_spans(text)
    known, marks = set(base), _marked(text, base)
    for span in proposals(text):
        # What overlaps a known span without being it, or would be one on its own, may be either.
        if span in known:
            yield features(text, span), 1
        elif marks.find(1, span[1], span[2]) < 0:
            alone = text[span[1] : span[2]]
            if (span[0], 0, len(alone)) not in base_spans(alone):
                yield features(text, span), 0
    for kind, start, end in base:
        left, right = text[max(0, start - AROUND) : start], text[end : end + AROUND]
        for before, after in _BESIDE if kind != EMAIL else ():
            local = left + before + text[start:end] + after + right
            yield features(local, (kind, len(left) + len(before), len(left) + len(before) + end - start)), 1
        for new, good in _rewritten(kind, text[start:end]):
            local = left + new + right
            whole = (kind, len(left), len(left) + len(new))
            for span in proposals(local):
                if span[1] < whole[2] and whole[1] < span[2]:
                    yield features(local, span), int(good and span == whole)


# ---- boosted trees ----

DEPTH, TREES, RATE, BINS, PENALTY = 4, 80, 0.2, 32, 1.0
# Gradients are whole multiples of 1 / UNIT, so that sums do not depend on their order.
UNIT = 1 << 20
_SHARES = np.linspace(0, 1, BINS + 1)[1:-1].tolist()


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: feature and threshold per inner node, a value per leaf, and a start value."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            total += leaf[_places(x, feature, threshold, DEPTH, rows) - (2**DEPTH - 1)]
        return total


def _places(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, level: int, rows: np.ndarray) -> np.ndarray:
    """The node of every row on a level of one tree."""
    at = np.zeros(len(x), dtype=np.int64)
    for _ in range(level):
        at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
    return at


def _start(n: int, good: int) -> float:
    share = np.clip(good / n if n else 0.5, 1e-3, 1 - 1e-3)
    return float(np.log(share / (1 - share)))


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The number of cuts below every value, so that ``x > cuts[c]`` is ``bin > c``."""
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _sums(
    bins: np.ndarray, n: np.ndarray, good: np.ndarray, margin: np.ndarray, feature: np.ndarray, threshold: np.ndarray, level: int
) -> np.ndarray:
    """First and second derivatives of the logistic loss by node of a level, feature and bin, in units."""
    width, m = 2**level, bins.shape[1]
    p = 1 / (1 + np.exp(-margin))
    node = _places(bins, feature, threshold, level, np.arange(len(bins))) - (width - 1)
    key = ((node[:, None] * m + np.arange(m)) * BINS + bins).ravel()
    sides = (n * p - good, n * p * (1 - p))
    return np.stack([np.bincount(key, np.repeat(np.rint(s * UNIT), m), width * m * BINS) for s in sides])


def _grown(m: int, start: float, sums: Callable[[Trees, np.ndarray, np.ndarray, int], np.ndarray]) -> Trees:
    """Gradient boosting with logistic loss: every node takes the split of largest gain over binned features.

    ``sums`` gives those of ``_sums`` for the trees so far and the splits of the
    next one above a level. The thresholds are bins.
    """
    inner = 2**DEPTH - 1
    trees = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), start)
    for _ in range(TREES):
        feature, threshold, leaf = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        for level in range(DEPTH):
            width, first = 2**level, 2**level - 1
            gs, hs = (sums(trees, feature, threshold, level) / UNIT).reshape(2, width, m, BINS).cumsum(axis=3)
            total_g, total_h = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + PENALTY) + (total_g - gs) ** 2 / (total_h - hs + PENALTY) - total_g**2 / (total_h + PENALTY)
            gain = gain[:, :, :-1].reshape(width, -1)
            best = gain.argmax(axis=1)
            for k, at in enumerate(best):
                split = gain[k, at] > 1e-9
                j, cut = divmod(int(at), BINS - 1) if split else (0, BINS - 1)
                if split:
                    feature[first + k], threshold[first + k] = j, cut
                # Rows of a node without a split go left.
                below = np.array([gs[k, j, cut], hs[k, j, cut]])
                for side, (g, h) in enumerate((below, np.array([gs[k, j, -1], hs[k, j, -1]]) - below)):
                    if level == DEPTH - 1:
                        leaf[2 * k + side] = -RATE * g / (h + PENALTY)
        trees = Trees(np.vstack([trees.feature, feature]), np.vstack([trees.threshold, threshold]), np.vstack([trees.leaf, leaf]), start)
    return trees


def _unbinned(trees: Trees, cuts: list[np.ndarray]) -> Trees:
    """The same trees for values instead of bins."""
    threshold = np.full(trees.threshold.shape, np.inf)
    for at in zip(*np.nonzero(np.isfinite(trees.threshold))):
        threshold[at] = cuts[trees.feature[at]][int(trees.threshold[at])]
    return Trees(trees.feature, threshold, trees.leaf, trees.start)


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for rows in memory."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], _SHARES)) if n else np.zeros(1) for j in range(m)]
    bins, ones = _binned(x, cuts), np.ones(n)

    def sums(trees: Trees, feature: np.ndarray, threshold: np.ndarray, level: int) -> np.ndarray:
        return _sums(bins, ones, y, trees.margins(bins), feature, threshold, level)

    return _unbinned(_grown(m, _start(n, y.sum()), sums), cuts)


Block = tuple[float, float, int]


def _pooled(blocks: Iterator[Block]) -> list[Block]:
    """Blocks (lowest margin, good ones, all) of an increasing fit: adjacent ones are pooled until their shares increase.

    Blocks of neighbouring ranges that were pooled on their own give the same.
    """
    out: list[Block] = []
    for block in blocks:
        out.append(block)
        while len(out) > 1 and out[-2][1] * out[-1][2] >= out[-1][1] * out[-2][2]:
            _, good, count = out.pop()
            out[-1] = (out[-1][0], out[-1][1] + good, out[-1][2] + count)
    return out


def _lowest(blocks: list[Block], precision: float) -> float:
    return next((low for low, good, count in blocks if good >= precision * count), float("inf"))


def calibrated(margins: np.ndarray, y: np.ndarray, precision: float = PRECISION) -> float:
    """The lowest margin from which on an increasing fit of the outcomes is at least ``precision``; infinite if none is."""
    order = np.argsort(margins, kind="stable")
    values, firsts = np.unique(margins[order], return_index=True)
    sums = np.add.reduceat(y[order].astype(float), firsts) if len(values) else np.zeros(0)
    counts = np.diff(np.append(firsts, len(order)))
    return _lowest(_pooled(zip(values.tolist(), sums.tolist(), counts.tolist())), precision)


@dataclass(frozen=True)
class Detector:
    trees: Trees
    thresholds: tuple[float, ...]

    def added(self, text: str, base: list[Span]) -> list[tuple[Span, float]]:
        """Accepted proposals that overlap no span of ``base`` and no better proposal, with their margins."""
        taken = _marked(text, base)
        free = [p for p in proposals(text) if taken.find(1, p[1], p[2]) < 0]
        ranked = []
        for i in range(0, len(free), _CHUNK):
            some = free[i : i + _CHUNK]
            margins = self.trees.margins(np.array([features(text, p) for p in some], dtype=float))
            ranked += [(-m, p[1], -p[2], p) for p, m in zip(some, margins.tolist()) if m >= self.thresholds[p[0]]]
        out: list[tuple[Span, float]] = []
        for m, _, _, p in sorted(ranked):
            if taken.find(1, p[1], p[2]) < 0:
                taken[p[1] : p[2]] = b"\1" * (p[2] - p[1])
                out.append((p, -m))
        return out


# ---- the fit ----

# Margins are written with the rows after so many trees.
_WRITTEN = 16
_TASKS = 64


def _batch(**columns: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def counted_examples(docs: DataFrame) -> DataFrame:
    """part, x, n and good: how often all texts give each row of features, and how often as one to find.

    ``x`` holds the features as 64-bit floats. Equal texts share a part.
    """
    form = f"<{len(FEATURES)}d"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[int, bytes], list[int]] = {}
            for text in batch.column("text").to_pylist():
                part = zlib.crc32(text.encode("utf-8", "surrogatepass")) % HELD_OUT
                for x, y in examples(text):
                    count = found.setdefault((part, struct.pack(form, *x)), [0, 0])
                    count[0] += 1
                    count[1] += y
            yield _batch(
                part=([k[0] for k in found], pa.int32()), x=([k[1] for k in found], pa.binary()),
                n=([c[0] for c in found.values()], pa.int64()), good=([c[1] for c in found.values()], pa.int64()),
            )

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.mapInArrow(make, "part int, x binary, n long, good long")
    return rows.groupBy("part", "x").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, len(FEATURES))


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def _exact_cuts(rows: DataFrame) -> list[np.ndarray]:
    """Exact quantiles of every feature over all examples."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, (n,) = _matrix(batch.column("x"), "<f8"), _numbers(batch, "n")
            for j in range(x.shape[1]):
                value, at = np.unique(x[:, j], return_inverse=True)
                count = np.bincount(at, n, len(value)).astype(np.int64)
                yield _batch(j=(np.full(len(value), j), pa.int32()), value=(value, pa.float64()), n=(count, pa.int64()))

    quantiles = rows.select("x", "n").mapInArrow(values, "j int, value double, n long").groupBy("j").agg(
        F.percentile("value", _SHARES, F.col("n")).alias("q")
    )
    found = {r["j"]: np.unique(r["q"]) for r in quantiles.collect()}
    return [found[j] for j in range(len(FEATURES))]


def _boosted(rows: DataFrame, start: float) -> tuple[Trees, DataFrame]:
    """Binned trees for the rows that are not held out, and all rows with their margins."""
    rows = materialise(rows.withColumn("margin", F.lit(start)), "examples")
    state = {"rows": rows, "trees": 0, "tasks": rows.rdd.getNumPartitions()}

    def newer(trees: Trees) -> Trees:
        """The trees that the written margins do not have, with a start of 0."""
        at = state["trees"]
        return Trees(trees.feature[at:], trees.threshold[at:], trees.leaf[at:], 0.0)

    def write(trees: Trees) -> None:
        new, schema = newer(trees), state["rows"].schema

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margin = batch.column("margin").to_numpy() + new.margins(_matrix(batch.column("bins"), np.uint8))
                yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margin))

        state["rows"] = materialise(state["rows"].mapInArrow(add, schema), "examples")
        state["trees"] = len(trees.leaf)

    def sums(trees: Trees, feature: np.ndarray, threshold: np.ndarray, level: int) -> np.ndarray:
        if len(trees.leaf) - state["trees"] == _WRITTEN:
            write(trees)
        new = newer(trees)

        def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                bins, (n, good, margin) = _matrix(batch.column("bins"), np.uint8), _numbers(batch, "n", "good", "margin")
                total = total + _sums(bins, n, good, margin + new.margins(bins), feature, threshold, level)
            if not isinstance(total, int):
                yield _batch(sums=([total.tobytes()], pa.binary()))

        def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [np.frombuffer(b) for batch in batches for b in batch.column("sums").to_pylist()]
            if parts:
                yield _batch(sums=([reduce(np.add, parts).tobytes()], pa.binary()))

        parts = state["rows"].filter("NOT held").select("bins", "n", "good", "margin").mapInArrow(some, "sums binary")
        if state["tasks"] > _TASKS:
            parts = parts.repartition(int(state["tasks"] ** 0.5)).mapInArrow(all_of, "sums binary")
        return reduce(np.add, [np.frombuffer(r["sums"]) for r in parts.collect()])

    trees = _grown(len(FEATURES), start, sums)
    write(trees)
    return trees, state["rows"]


def _thresholds(rows: DataFrame, precision: float = PRECISION) -> tuple[float, ...]:
    """The calibrated threshold of every kind over all rows (kind, margin, n, good)."""

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list[Block]] = {}
        for batch in batches:
            found: dict[int, list[Block]] = {}
            for kind, *block in zip(*(batch.column(c).to_pylist() for c in ("kind", "margin", "good", "n"))):
                found.setdefault(kind, []).append(tuple(block))
            blocks |= {kind: _pooled([*blocks.get(kind, []), *own]) for kind, own in found.items()}
        flat = [(kind, *block) for kind, own in blocks.items() for block in own]
        kinds, lows, goods, counts = zip(*flat) if flat else ((), (), (), ())
        yield _batch(kind=(kinds, pa.int32()), margin=(lows, pa.float64()), good=(goods, pa.int64()), n=(counts, pa.int64()))

    sums = rows.groupBy("kind", "margin").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    ranges = sums.repartitionByRange("kind", "margin").sortWithinPartitions("kind", "margin").select("kind", "margin", "good", "n")
    pooled = sorted(ranges.mapInArrow(pool, "kind int, margin double, good long, n long").collect())
    return tuple(_lowest(_pooled(tuple(r)[1:] for r in pooled if r["kind"] == k), precision) for k in range(len(KINDS)))


def learn(docs: DataFrame) -> Detector:
    """Fit the trees and thresholds on the examples of all ``docs`` (doc_id, text).

    A third of the texts is held out of the trees for the thresholds. Equal
    examples are one row with a count, and Spark sums over the rows: the driver
    gets quantiles, sums by node, feature and bin, and the blocks of the
    increasing fits. Where a kind has no examples its threshold is infinite,
    and only the fixed pattern finds it.
    """
    counted = materialise(counted_examples(docs), "examples")
    parts = {r["part"] for r in counted.select("part").distinct().collect()}
    held = F.col("part") == 0
    if parts and (parts == {0} or 0 not in parts):
        held = F.crc32("x") % HELD_OUT == 0
    counted = counted.withColumn("held", held)
    fitted = counted.filter("NOT held")
    n, good = fitted.agg(F.sum("n"), F.sum("good")).first()
    if not n:
        return Detector(fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0)), (float("inf"),) * len(KINDS))
    cuts = _exact_cuts(fitted)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), "<f8")
            kind, rows = x[:, : len(KINDS)].argmax(axis=1), _binned(x, cuts)
            columns = [batch.column("held"), pa.array(kind, pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("n"), batch.column("good")], names=["held", "kind", "bins", "n", "good"])

    rows = counted.select("held", "x", "n", "good").mapInArrow(bins, "held boolean, kind int, bins binary, n long, good long")
    rows = rows.groupBy("held", "kind", "bins").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    trees, rows = _boosted(rows, _start(n, good))
    return Detector(_unbinned(trees, cuts), _thresholds(rows.filter("held")))


SPANS = "array<struct<kind: string, start: int, end: int, base: boolean, margin: double>>"


def spans(model: Detector) -> Column:
    """Function of a text column: its spans by kind and start, in code points, the end exclusive.

    ``margin`` is the score of an added span. Null and empty texts have none.
    """

    @F.pandas_udf(SPANS)
    def find(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            text = text or ""
            base = base_spans(text)
            rows = [(k, s, e, True, None) for k, s, e in base]
            rows += [(*p, False, m) for p, m in model.added(text, base)]
            rows.sort(key=lambda r: r[:3])
            out.append([{"kind": KINDS[k], "start": s, "end": e, "base": b, "margin": m} for k, s, e, b, m in rows])
        return pd.Series(out)

    return find


def with_spans(docs: DataFrame, model: Detector, name: str = "spans", text: str = "text") -> DataFrame:
    """``docs`` with the personal data in their texts as the column ``name``; rows and other columns stay as they are.

    Null and empty texts have no spans, repeated rows the same ones, and an
    empty table stays empty. ``name`` must be new to ``docs``.
    """
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {name} already")
    return docs.withColumn(name, spans(model)(F.col(f"`{text}`")))


def redacted(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named after the first."""
    by_start = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("z"), s["kind"].alias("k"))))
    step = F.aggregate(
        by_start,
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda t, s: F.struct(
            F.when(
                s["a"] >= t["at"],
                F.concat(t["done"], F.substring(text, t["at"] + 1, s["a"] - t["at"]), F.lit("["), F.upper(s["k"]), F.lit("]")),
            ).otherwise(t["done"]).alias("done"),
            F.greatest(t["at"], s["z"]).alias("at"),
        ),
    )
    return F.concat(step["done"], F.substring(text, step["at"] + 1, F.length(text)))
