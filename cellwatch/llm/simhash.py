"""Near duplicates by 64-bit SimHash, linked through the pigeonring principle.

Fingerprints within ``distance`` bits are cut into ``distance + 1`` segments on
a ring. The pigeonring principle: some segment starts a chain in which, for
every length l, the first l segments differ in at most l * distance / segments
bits. The first segment of that chain is equal in both, so candidates meet in
buckets of equal segments; a candidate that breaks a budget along the ring is
pruned before its full distance is taken.

Equal fingerprints are one row throughout. A bucket of more than
``small_bucket`` fingerprints is never paired: there every fingerprint is sent
to itself and to its one-bit neighbours outside the bucket's segment, and all
that meet at one point are linked to the smallest. Two fingerprints at distance
2 meet half way, those at distance 1 at either end, so no link is lost, and any
two that meet are within 2. The work stays in proportion to the bucket. This
way holds for a distance of 2 only; ``pairs_within`` takes any distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.components import components
from cellwatch.llm.frames import materialise

BITS = 64
SHINGLE_WORDS = 3
SEED = 42
DISTANCE = 2
SMALL_BUCKET = 32
_BLOCK = 4096


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """SimHash of the shingles of a text, as an unsigned integer.

    A-Z are lower-cased, words lie between ASCII white space, repeats count.
    Fewer words than ``width`` are one shingle; no word gives zero.
    """
    import xxhash

    # bytes.lower and bytes.split touch ASCII only, which is the rule here.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    begins = [0, *[e + 1 for e in ends[: len(words) - width]]]
    n = len(begins)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, _BLOCK):
        h = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(begins[i : i + _BLOCK], ends[i + width - 1 : i + width - 1 + _BLOCK])],
            dtype="<u8",
        )
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > n))


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint's 64 bits as a signed long) of every row."""
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, width) for t in batch.column(2).to_pylist()]
            signed = np.array(fps, dtype=np.uint64).view(np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(signed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(compute, "doc_id long, text_hash long, fp long")


def segments(distance: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each of ``distance + 1`` segments."""
    m = distance + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mask(low: int, width: int) -> int:
    value = ((1 << width) - 1) << low
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _chain_holds(a: Column, b: Column, start: int, distance: int) -> Column:
    """Whether the chain from ``start`` keeps every budget before the last, all segments."""
    parts = segments(distance)
    m = len(parts)
    total, holds = F.lit(0), F.lit(True)
    for length in range(1, m):
        low, width = parts[(start + length - 1) % m]
        total = total + F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit(_mask(low, width)).cast("long")))
        holds = holds & (total * m <= length * distance)
    return holds


def _flips(start: int, distance: int) -> list[int]:
    """Masks of no bit and of each one bit outside the segment."""
    low, width = segments(distance)[start]
    found = [0, *[1 << b for b in range(BITS) if not low <= b < low + width]]
    return [f - (1 << BITS) if f >= 1 << (BITS - 1) else f for f in found]


def links(points: DataFrame, distance: int = DISTANCE, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """Links (a, b), a < b, between distinct ``fp`` whose closure is that of all pairs within ``distance``.

    Every pair within the distance is joined by a path of the links returned,
    and every link returned lies within the distance.
    """
    if distance != 2:
        raise ValueError("only a distance of 2 is supported")
    parts = segments(distance)
    keys = F.array(
        *[
            F.struct(
                F.lit(i).alias("seg"),
                F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1).cast("long")).alias("value"),
            )
            for i, (low, width) in enumerate(parts)
        ]
    )
    # One row per fingerprint and segment; the bucket's size comes by a join, so a large bucket is no task of its own.
    keyed = points.select("fp", F.explode(keys).alias("k")).select("fp", "k.seg", "k.value")
    sizes = materialise(keyed.groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sizes")
    crowded = materialise(keyed.join(sizes, ["seg", "value"]), "buckets")

    small = crowded.filter(F.col("n") <= small_bucket)
    a, b = small.alias("a"), small.alias("b")
    x, y = F.col("a.fp"), F.col("b.fp")
    holds = F.lit(False)
    for i in range(len(parts)):
        holds = holds | ((F.col("a.seg") == i) & _chain_holds(x, y, i, distance))
    paired = (
        a.join(b, (F.col("a.seg") == F.col("b.seg")) & (F.col("a.value") == F.col("b.value")) & (x < y))
        .filter(holds)
        .filter(F.bit_count(x.bitwiseXOR(y)) <= distance)
        .select(x.alias("a"), y.alias("b"))
    )

    flips = F.lit(None)
    for i in range(len(parts)):
        flips = F.when(F.col("seg") == i, F.array(*[F.lit(f).cast("long") for f in _flips(i, distance)])).otherwise(flips)
    # A point reached is a fingerprint with the bucket's segment in it, so it names the bucket as well.
    reached = (
        crowded.filter(F.col("n") > small_bucket)
        .select("fp", "seg", F.explode(flips).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
        .distinct()
    )
    reached = materialise(reached, "reached")
    smallest = reached.groupBy("point").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    starred = (
        reached.join(materialise(smallest.select("point", "least"), "smallest"), "point")
        .filter("fp <> least")
        .select(F.col("least").alias("a"), F.col("fp").alias("b"))
    )
    return paired.unionByName(starred).distinct()


def _classes(documents: DataFrame, doc_id: str, text: str, width: int, distance: int, small_bucket: int):
    """doc_id, text_hash and fp of every row; and per fingerprint its root, a fingerprint that names the class."""
    rows = materialise(fingerprints(documents, doc_id, text, width), "fingerprints")
    points = rows.select("fp").distinct()
    member = components(materialise(links(points, distance, small_bucket), "links"), "a", "b")
    roots = points.join(member.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return rows, materialise(roots, "roots")


def near_duplicates(
    documents: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    small_bucket: int = SMALL_BUCKET,
) -> DataFrame:
    """doc_id, fp and component_id of every row.

    component_id is the smallest id in the row's class; a class is closed under
    fingerprints within ``distance`` bits. Null and blank texts have fingerprint
    zero and are linked like others. Null ids never become a component_id
    unless the class has no other id. Repeated rows stay. No columns but id and
    text are read. An empty table gives no rows.
    """
    rows, roots = _classes(documents, doc_id, text, width, distance, small_bucket)
    # Classes are settled per fingerprint. What is joined is written first: a
    # join of two plain tables can be split where a fingerprint or a class is hot.
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    least = materialise(first.join(roots, "fp").groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    classes = materialise(roots.join(least, "root").select("fp", "component_id"), "classes")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def first_of_each(
    documents: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    small_bucket: int = SMALL_BUCKET,
) -> DataFrame:
    """One row of each class with all its columns: that of the smallest id, nulls last.

    Of rows that share this id the one of the smallest text hash stays, and of
    equal ones any single one.
    """
    rows, roots = _classes(documents, doc_id, text, width, distance, small_bucket)
    return firsts(documents, rows, roots, doc_id, text)


def firsts(documents: DataFrame, rows: DataFrame, roots: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The first document of each root; ``rows`` and ``roots`` as ``_classes`` gives them."""
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    by_root = rows.groupBy("fp").agg(F.min(rank).alias("k")).join(roots, "fp").groupBy("root").agg(F.min("k").alias("k"))
    keep = materialise(by_root.select(F.col("k.doc_id").alias("_keep"), F.col("k.text_hash").alias("_hash")), "kept")
    kept = documents.join(
        keep, documents[doc_id].cast("long").eqNullSafe(keep["_keep"]) & (F.xxhash64(documents[text]) == keep["_hash"]), "left_semi"
    )
    same = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return kept.dropDuplicates([doc_id, text]) if same.head(1) else kept


def pairs_within(points: DataFrame, distance: int, block: int = 1024) -> DataFrame:
    """All pairs (a, b), a < b, of distinct ``fp`` that differ in at most ``distance`` bits, for any distance under 64.

    Candidates meet in equal segments and must keep the chain's budgets. A
    bucket of more than ``block`` fingerprints is cut into blocks by hash, and
    every two blocks meet in a group of their own, so no bucket is one task. No
    pair is left out; the pairs compared grow with the squares of the buckets,
    which at large distances (short segments) hold much of the table.
    """
    if not 0 <= distance < BITS:
        raise ValueError("a distance lies between 0 and 63")
    parts = segments(distance)
    keys = F.array(
        *[
            F.struct(
                F.lit(i).alias("seg"),
                F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(_mask(0, width)).cast("long")).alias("value"),
            )
            for i, (low, width) in enumerate(parts)
        ]
    )
    keyed = points.select("fp").distinct().select("fp", F.explode(keys).alias("k")).select("fp", "k.seg", "k.value")
    sizes = materialise(keyed.groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sizes")
    blocks = F.ceil(F.col("n") / block).cast("int")
    crowded = keyed.join(sizes, ["seg", "value"]).withColumn("blocks", blocks)
    own = crowded.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    # Group (i, j), i <= j, holds the blocks i and j.
    meets = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "fp", "seg", "value", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    meets = materialise(meets, "meets")
    a, b = meets.alias("a"), meets.alias("b")
    x, y = F.col("a.fp"), F.col("b.fp")
    holds = F.lit(False)
    for i in range(len(parts)):
        holds = holds | ((F.col("a.seg") == i) & _chain_holds(x, y, i, distance))
    same = F.lit(True)
    for c in ("seg", "value", "i", "j"):
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    # Within the group of two blocks only pairs across them count, so no pair comes from several groups.
    across = (F.col("a.i") == F.col("a.j")) | (F.col("a.own") != F.col("b.own"))
    near = same & across & (x < y) & (F.bit_count(x.bitwiseXOR(y)) <= distance)
    return a.join(b, near).filter(holds).select(x.alias("a"), y.alias("b")).distinct()
