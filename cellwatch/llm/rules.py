"""Quality rules as a ledger of failure bits.

``ledger`` measures every text once and evaluates every rule once; the row
keeps the measurements and one ``long`` of failure bits. Policies are named,
versioned sets of rules: applying one is a bit test, and the effect of leaving
out any rule comes from counting bit patterns, so thresholds are never
evaluated again. Everything stays inside the row; nothing is shuffled except
the pattern counts of ``ablation``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.frames import blank_words

WINDOW = 8

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclamations", "n_capitals",
    "n_same_words",
)


def _count(pattern: str) -> Column:
    return F.regexp_count(F.col("t"), F.lit(pattern)).cast("long")


def _repeat_words(starts: Column) -> Column:
    """Words covered by windows that begin at the ascending ``starts``."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(a: Column, p: Column) -> Column:
        end = p + F.lit(WINDOW)
        return F.struct(end.alias("end"), (a["n"] + end - F.greatest(a["end"], p)).alias("n"))

    return F.aggregate(starts, zero, add, lambda a: a["n"])


def measure(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the measurements of every row, all of them long.

    Windows of eight words are compared by a 64-bit hash within one text. Null
    and blank texts have zero everywhere; repeated rows give repeated rows.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumns(
        {"w": blank_words(F.col("t")), "l": F.filter(F.split("t", "\n", -1), lambda x: x.rlike("[^ \\t-\\r]"))}
    )
    rows = rows.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    last = F.size("h") - WINDOW
    rows = rows.withColumn(
        "v",
        F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(F.col("h"), i + F.lit(j)) for j in range(WINDOW)])
            ),
        ).otherwise(F.array().cast("array<long>")),
    )
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("v")) < F.size("v")
    pairs = F.transform("v", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn("s", F.when(repeats, F.sort_array(pairs)))
    same = F.filter(
        "s",
        lambda x, j: (x["h"] == F.get(F.col("s"), j + 1)["h"]).eqNullSafe(F.lit(True))
        | ((j > 0) & (x["h"] == F.get(F.col("s"), j - 1)["h"])),
    )
    starts = F.sort_array(F.transform(same, lambda x: x["i"]))
    return rows.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda n, x: n + F.char_length(x)).alias("word_chars"),
        _count("[#*$%&|<>]").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("s").isNull(), F.lit(0).cast("long")).otherwise(_repeat_words(starts)).alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        _count("!").alias("n_exclamations"),
        _count("\\p{Lu}").alias("n_capitals"),
        F.size(F.filter("h", lambda x, i: (i > 0) & (x == F.get(F.col("h"), i - 1)))).cast("long").alias("n_same_words"),
    )


@dataclass(frozen=True)
class Rule:
    """A failure condition over measurements, kept at one bit of the ledger for good."""

    bit: int
    name: str
    fails: Callable[[], Column]


@dataclass(frozen=True)
class Policy:
    """A version and the rules that it enforces."""

    version: str
    rules: tuple[str, ...]


RULES = (
    Rule(0, "few_words", lambda: F.col("n_words") < 20),
    Rule(1, "repeated_words", lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    Rule(2, "symbols", lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words")),
    Rule(3, "duplicate_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule(4, "short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule(5, "long_words", lambda: F.col("word_chars") > 20 * F.col("n_words")),
    Rule(6, "exclamations", lambda: 10 * F.col("n_exclamations") > 3 * F.col("n_words")),
    Rule(7, "capitals", lambda: 2 * F.col("n_capitals") > F.col("word_chars")),
    Rule(8, "same_words", lambda: 10 * F.col("n_same_words") > 3 * F.col("n_words")),
)
BASE = Policy("base-1", ("few_words", "repeated_words"))
STANDARD = Policy("standard-1", tuple(r.name for r in RULES))


def ledger(documents: DataFrame, rules: Sequence[Rule] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements of every row and ``failures``, the bits of the rules that it fails.

    One output row per input row, also for repeated rows and null ids; other
    columns of the input are not read. An empty table gives an empty ledger.
    """
    if len({r.bit for r in rules}) != len(rules) or any(not 0 <= r.bit < 63 for r in rules):
        raise ValueError("every rule needs a bit of its own from 0 to 62")
    zero = F.lit(0).cast("long")
    failures = zero
    for r in rules:
        failures = failures.bitwiseOR(F.when(r.fails(), F.lit(1 << r.bit).cast("long")).otherwise(zero))
    return measure(documents, doc_id, text).withColumn("failures", failures)


def mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[name] for name in set(policy.rules))


def fails(policy: Policy, rules: Sequence[Rule] = RULES, failures: str = "failures") -> Column:
    """Whether a ledger row fails any rule of the policy."""
    return F.col(failures).bitwiseAND(F.lit(mask(policy, rules)).cast("long")) != 0


def ablation(rows: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of the policy: rows failing it, failing only it, and kept without it.

    The ledger is reduced to counts per bit pattern (at most 2 to the number of
    rules) before rules are looked at.
    """
    own = F.lit(mask(policy, rules)).cast("long")
    patterns = rows.groupBy(F.col("failures").bitwiseAND(own).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
    bits = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules if r.name in policy.rules]
    )
    hit = F.col("pattern").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("pattern") == F.col("r.bit")
    return (
        patterns.select("pattern", "n", F.explode(bits).alias("r"))
        .groupBy(F.lit(policy.version).alias("policy"), F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failing"),
            F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_only_this"),
            F.sum(F.when((F.col("pattern") == 0) | alone, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )
