"""Spelling variants: words one edit apart, under the far more frequent word they stand for.

Neighbours are found by walking a trie of all words, all words at once. States
(word, position, node, edits) are joined with the table of edges, level by
level; a state that ends at a word after one edit makes the two neighbours.

Two words part at one place: after their longest common prefix. So an edit can
only happen at a node where words part, right at the start of an edge, and the
rest of the path must equal the rest of the word. Chains of single children are
one edge with a long label; the number of levels is that of partings on a path,
not that of letters. Near the root nearly everything parts, so words are walked
from their middle on, in the trie of the words and in that of the reversed
words: an edit in the first half lies in the second half of the reversed word.

Nodes are 64-bit hashes of their prefixes. A collision could only add pairs,
and every pair is checked at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.session import materialise

# Fixed values of the word rule: which letters make a run.
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_runs(text: Column, least: int) -> Column:
    """Maximal runs of letters with at least ``least`` of them, A-Z lower-cased; null texts have none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"({RUN}{{{max(1, least)},}})"), F.lit(1))


def word_counts(words: DataFrame, min_length: int = 7, min_count: int = 2) -> DataFrame:
    """word and n of the words in the column ``word`` that are long and frequent enough.

    Null words do not count. Repeated rows count every time.
    """
    kept = words.select("word").filter(F.length("word") >= min_length)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _start(way: Column, size: Column) -> Column:
    half = F.floor(size / 2).cast("int")
    return F.when(way == 0, half).otherwise(size - half)


def _spelled(words: DataFrame) -> DataFrame:
    """Every word in both directions as ``s``, with ``start``, the place from which edits are looked for."""
    ways = F.array(
        F.struct(F.lit(0).alias("way"), F.col("word").alias("s")),
        F.struct(F.lit(1).alias("way"), F.reverse("word").alias("s")),
    )
    return words.select(F.inline(ways)).withColumn("start", _start(F.col("way"), F.length("s")))


def _bit(number: Column) -> Column:
    """A mask with the one bit that stands for ``number``."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(64)).cast("int"))


def _stops(spelled: DataFrame) -> DataFrame:
    """way, s, start and ``stops``: the places on the path of ``s`` where words part or end.

    A neighbour is at most one letter longer, so its path counts from one
    letter before its own start. ``letters`` and ``rests`` are masks of the
    letters and of the whole remainders that go on from a place; a clear bit
    says that there is none, a set one says nothing.
    """
    size = F.length("s")
    # Long words are known by a digest, so that their places do not carry them.
    long = size > 32
    spelled = spelled.withColumn("key", F.when(long, F.concat(F.lit("#"), F.md5("s"))).otherwise(F.col("s")))
    begin = F.greatest(F.lit(0), F.col("start") - 1)
    # Exploded before anything is computed: the body of a transform would not be compiled.
    places = spelled.select("way", "key", "s", F.explode(F.sequence(begin, size)).alias("p")).select(
        "way",
        "key",
        "p",
        F.xxhash64("way", F.substring("s", F.lit(1), F.col("p"))).alias("node"),
        F.substring("s", F.col("p") + 1, F.lit(1)).alias("letter"),
        F.xxhash64(F.substring("s", F.col("p") + 1, F.length("s"))).alias("rest"),
    )
    # The end of a word is the empty letter, the smallest.
    nodes = places.groupBy("node").agg(
        F.min("letter").alias("low"),
        F.max("letter").alias("high"),
        F.bit_or(_bit(F.ascii("letter"))).alias("letters"),
        F.bit_or(_bit(F.col("rest"))).alias("rests"),
    )
    parting = nodes.filter((F.col("low") != F.col("high")) | (F.col("low") == "")).select(
        "node", (F.col("low") == "").alias("terminal"), "letters", "rests"
    )
    stop = F.struct("p", "node", "terminal", "letters", "rests")
    # A node stands once in ``parting``, so no partition of it can be hot.
    met = places.join(parting.hint("shuffle_hash"), "node")
    stops = met.groupBy("way", "key").agg(F.sort_array(F.collect_list(stop)).alias("stops"))
    whole = spelled.filter(long).select("way", "key", "s")
    stops = stops.join(whole, ["way", "key"], "left").select("way", F.coalesce("s", "key").alias("s"), "stops")
    return stops.select("way", "s", _start(F.col("way"), F.length("s")).alias("start"), "stops")


def _edges(stops: DataFrame) -> DataFrame:
    """node, first, label, child, ``ending``: the word that ends at the child, and the masks of the child."""
    n = F.size("stops")
    pairs = F.when(n > 1, F.arrays_zip(
        F.slice("stops", F.lit(1), n - 1).alias("a"), F.slice("stops", F.lit(2), n - 1).alias("b")
    ))
    steps = stops.select("s", F.explode(pairs).alias("e")).select(
        F.col("e.a.node").alias("node"),
        F.expr("substring(s, e.a.p + 1, e.b.p - e.a.p)").alias("label"),
        F.col("e.b.node").alias("child"),
        F.expr("CASE WHEN e.b.terminal THEN substring(s, 1, e.b.p) END").alias("ending"),
        F.col("e.b.letters").alias("letters"),
        F.col("e.b.rests").alias("rests"),
    )
    first = F.substring("label", 1, 1)
    columns = ["label", "child", "ending", "letters", "rests"]
    return steps.groupBy("node", first.alias("first")).agg(*[F.min(c).alias(c) for c in columns])


_STATE = ["way", "s", "pos", "node", "edits", "ending"]


def _first_states(stops: DataFrame) -> DataFrame:
    """No edit yet, at the first parting at or after the start."""
    at = F.get(F.filter("stops", lambda x: x["p"] >= F.col("start")), F.lit(0))
    return stops.withColumn("at", at).filter("at is not null").select(
        "way", "s", F.col("at.p").alias("pos"), F.col("at.node").alias("node"), F.lit(0).alias("edits"),
        F.expr("CASE WHEN at.terminal THEN substring(s, 1, at.p) END").alias("ending"),
    )


def _moved(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one edge further: along the word, or with the one edit at the start of the edge.

    After the edit a state lives on only where a word ends with it, or where the
    masks of the child do not rule out its next letter and its remainder.
    """
    own = F.substring(F.col("s"), F.col("pos") + 1, F.lit(1)) == F.col("first")
    on = (F.col("t.node") == F.col("e.node")) & ((F.col("edits") == 0) | own)
    # A node has at most one edge a letter, so no partition of edges can be hot.
    joined = states.drop("ending").alias("t").join(edges.alias("e").hint("shuffle_hash"), on).selectExpr(
        "way", "s", "pos", "edits", "label", "child", "ending", "letters", "rests", "length(label) AS size",
        "substring(s, pos + 1, 1) = first AS own", "substring(label, 2) AS tail", "length(s) AS whole",
    )

    def alive(pos: str) -> str:
        letter, rest = f"ascii(substring(s, {pos} + 1, 1))", f"xxhash64(substring(s, {pos} + 1, whole))"
        return (
            f"CASE WHEN {pos} = whole THEN ending IS NOT NULL ELSE {pos} < whole AND getbit(letters, pmod({letter}, 64)) = 1 "
            f"AND getbit(rests, int(pmod({rest}, 64))) = 1 END"
        )

    moves = [
        ("edits = 0 AND own", "pos + size", 0),
        (f"edits = 1 AND substring(s, pos + 1, size) = label AND {alive('pos + size')}", "pos + size", 1),
        # Another letter; a letter more; a letter less.
        (f"edits = 0 AND NOT own AND pos + size <= whole AND {alive('pos + size')} AND substring(s, pos + 2, size - 1) = tail",
         "pos + size", 1),
        (f"edits = 0 AND NOT own AND {alive('pos + size - 1')} AND substring(s, pos + 1, size - 1) = tail", "pos + size - 1", 1),
        (f"edits = 0 AND NOT own AND {alive('pos + size + 1')} AND substring(s, pos + 2, size) = label", "pos + size + 1", 1),
    ]
    # Most edges lead nowhere, so rows are dropped before arrays are made. No
    # lambdas here: Spark would not compile what stands around them.
    some = joined.filter(" OR ".join(f"({condition})" for condition, _, _ in moves))
    nexts = [f"CASE WHEN {condition} THEN named_struct('pos', {pos}, 'edits', {edits}) END" for condition, pos, edits in moves]
    moved = some.selectExpr("way", "s", "child AS node", "ending", f"inline(array({', '.join(nexts)}))")
    return moved.filter("pos IS NOT NULL").select(_STATE)


def _ended(states: DataFrame) -> DataFrame:
    """Words that end where their state does, after one edit; the last letter may be the one that is left out."""
    whole = F.length("s")
    there = (F.col("edits") == 1) & (F.col("pos") == whole)
    short = (F.col("edits") == 0) & (F.col("pos") == whole - 1)
    return states.filter((there | short) & F.col("ending").isNotNull()).select("way", "s", "ending")


def neighbours(words: DataFrame) -> DataFrame:
    """word and near: every ordered pair of the words in ``word`` that one inserted, deleted or replaced code point separates.

    Repeated words count once, null and empty words have no neighbours. The
    loop ends when no state is left.
    """
    distinct = words.select("word").filter("word <> ''").distinct()
    stops = materialise(_stops(_spelled(distinct)), "trie-stops")
    edges = materialise(_edges(stops), "trie-edges")
    states = materialise(_first_states(stops), "trie-states")
    found = [_ended(states)]
    while not states.isEmpty():
        states = materialise(_moved(states, edges), "trie-states")
        found.append(_ended(states))
    pairs = reduce(DataFrame.unionByName, found)

    def turned(c: str) -> Column:
        return F.when(F.col("way") == 1, F.reverse(c)).otherwise(F.col(c))

    pairs = pairs.select(turned("s").alias("word"), turned("ending").alias("near")).distinct()
    return pairs.filter(F.levenshtein("word", "near", 1) == 1)


def _roots(forms: DataFrame) -> DataFrame:
    """word and root: the last form of each word that has one.

    A form is at least ``ratio`` times as frequent, so chains cannot close. Each
    round doubles the links that a word follows.
    """
    roots = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = roots.join(further, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
        )
        moved = materialise(moved, "roots")
        roots = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            return roots


def variant_groups(counts: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word in ``counts`` (word, n, one row a word).

    A word's form is its most frequent neighbour, if that is at least ``ratio``
    (more than 1) times as frequent; of equally frequent ones the first in
    code-point order. ``root`` is the last form that follows. Other columns are
    left out; an empty table gives an empty result; rows without a word are
    left out.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1, or forms could follow each other in circles")
    counts = materialise(counts.select("word", "n").filter("word is not null"), "words")
    near = neighbours(counts).join(counts.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    )
    rows = counts.join(best, "word", "left")
    taken = -F.col("best.m") >= ratio * F.col("n")
    rows = materialise(
        rows.select(
            "word",
            F.when(taken, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(taken, -F.col("best.m")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(rows.filter("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
