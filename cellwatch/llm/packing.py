"""Best-fit packing of token pieces, with lower bounds that certify the number of bins.

Pieces are dealt to partitions of a bounded number of rows. Every partition is
packed by best-fit decreasing and gets a lower bound from dual feasible
functions: functions f on lengths such that pieces which fit into one sequence
never sum to more than 1, so the sum of f over all pieces bounds the number of
sequences from below. The sums add up over partitions, so the whole corpus has
such a bound as well, from one histogram of lengths.

While the corpus uses more sequences than its bound, the emptiest sequences of
all partitions are exchanged: their pieces are dealt anew over fewer partitions
and packed again, all other sequences are closed. So many are taken that their
free space could hold twice the sequences to be saved, or as many as fill one
partition. Rounds end when the bound is met, when a round saves nothing, or when
the exchanged pieces have been packed in one partition.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.frames import materialise
from cellwatch.llm.tokens import encoded

CAPACITY = 1024
PARTITION_PIECES = 250_000
MAX_ROUNDS = 8

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter than the capacity."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def token_pieces(
    documents: DataFrame,
    tokenizer: str,
    *,
    end_id: int = 2,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of every row's ids and its end id: doc_id, piece, start, length, ids_crc32.

    ``with_ids`` adds the ids, as little-endian unsigned 32-bit integers in a
    binary column. Null texts are empty texts: one piece of one id.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    end = int(end_id).to_bytes(4, "little")

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, raw in enumerate(encoded(tokenizer, batch.column(1).to_pylist())):
                raw += end
                for k, (at, n) in enumerate(cut(len(raw) // 4, capacity)):
                    part = raw[4 * at : 4 * (at + n)]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = {
                "doc_id": batch.column(0).take(pa.array(row, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int32()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(encode_all, PIECES + (", ids binary" if with_ids else ""))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in it, and fill of that bin, for every length.

    Lengths are whole numbers, so open bins are kept by their free space, and
    the tightest bin that fits is the lowest set bit at or above the length.
    """
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    fills: list[int] = []
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fitting = used >> n
        if fitting:
            space = n + (fitting & -fitting).bit_length() - 1
            at = free[space].pop()
            if not free[space]:
                used ^= 1 << space
        else:
            space, at = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = at, capacity - space
        fills[at] += n
        left = space - n
        if left:
            free[left].append(at)
            used |= 1 << left
    return bins, offsets, np.asarray(fills, np.int64)[bins] if fills else bins


def dual_bound(counts: dict[int, int], capacity: int) -> int:
    """Largest bound on the number of bins that three families of dual feasible functions give.

    ``counts`` says how many pieces each length has. The families: rounding to
    multiples of 1/k; dropping lengths under a threshold and counting those
    over its complement as a whole bin; both with the identity among them.
    """
    if not counts:
        return 0
    sizes = sorted(counts)
    best = Fraction(sum(n * c for n, c in counts.items()), capacity)
    for k in range(1, 21):
        total = Fraction(0)
        for n in sizes:
            scaled = (k + 1) * n
            f = Fraction(n, capacity) if scaled % capacity == 0 else Fraction(scaled // capacity, k)
            total += f * counts[n]
        best = max(best, total)
    half = capacity // 2
    arr = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        arr[n] = c
    number = np.cumsum(arr)
    weight = np.cumsum(arr * np.arange(capacity + 1))
    for low in sorted({n for n in sizes if n <= half}):
        big = int(number[-1] - number[capacity - low])
        middle = int(weight[capacity - low] - weight[low - 1]) if low else int(weight[capacity])
        best = max(best, big + Fraction(middle, capacity))
    return math.ceil(best)


def _histogram(rows: DataFrame, length: str) -> dict[int, int]:
    """Counts per length; as many rows as there are lengths, so the capacity at most."""
    return {r[0]: r[1] for r in rows.groupBy(length).agg(F.count(F.lit(1))).collect()}


def _pack_dealt(rows: DataFrame, schema: str, groups: int, round_no: int, capacity: int, length: str) -> DataFrame:
    def pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
        # The deal number fixes the order, whatever order the shuffle delivers.
        pdf = pdf.sort_values("_deal", kind="stable").reset_index(drop=True)
        bins, offsets, fills = best_fit_decreasing(pdf[length].to_numpy(np.int64), capacity)
        group = int(pdf["_group"].iloc[0])
        counts = pdf[length].value_counts()
        bound = dual_bound({int(n): int(c) for n, c in counts.items()}, capacity)
        out = pdf.drop(columns=["_group", "sequence_id", "offset", "fill", "bins", "bound"], errors="ignore")
        out["sequence_id"] = (round_no << 56) + (group << 24) + bins
        out["offset"] = offsets
        out["fill"] = fills
        out["bins"] = int(bins.max()) + 1
        out["bound"] = bound
        return out

    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("_deal", F.lit(round_no)), F.lit(groups)).cast("int"))
    return dealt.groupBy("_group").applyInPandas(pack_group, schema)


def _emptiest(packed: DataFrame, capacity: int, gap: int, partition_pieces: int) -> int:
    """Up to which fill sequences are exchanged to save ``gap`` of them; read from one row per fill."""
    rows = packed.groupBy("fill").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("offset") == 0).alias("bins")).collect()
    free = n = last = 0
    for r in sorted(rows, key=lambda r: r["fill"]):
        if r["fill"] == capacity or (free >= 2 * gap * capacity and n + r["n"] > partition_pieces):
            break
        free, n, last = free + (capacity - r["fill"]) * r["bins"], n + r["n"], r["fill"]
    return last


def pack(
    pieces: DataFrame,
    *,
    capacity: int = CAPACITY,
    length: str = "length",
    partition_pieces: int = PARTITION_PIECES,
    max_rounds: int = MAX_ROUNDS,
) -> tuple[DataFrame, dict]:
    """``pieces`` with sequence_id and offset, and a certificate of the whole packing.

    Lengths are whole numbers from 1 to the capacity. The certificate is a dict
    of sequences (used), bound (no packing needs fewer), certified (both equal)
    and rounds, each with its partitions, those certified by their own bound,
    its sequences and the pieces exchanged. An empty table gives an empty one
    and a bound of 0. Repeated rows are pieces of their own.
    """
    # The deal number is stored with the rows, so a task that runs again deals the same way.
    todo = materialise(pieces.withColumn("_deal", F.monotonically_increasing_id()), "pieces")
    plain = [f"`{f.name}` {f.dataType.simpleString()}" for f in todo.schema]
    schema = ", ".join([*plain, "sequence_id long", "offset long", "fill long", "bins long", "bound long"])
    counts = _histogram(todo, length)
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    bound, n = dual_bound(counts, capacity), sum(counts.values())
    done: list[DataFrame] = []
    rounds: list[dict] = []
    closed_bins = 0
    best = None  # the open rows of the best round so far, and their sequences
    for round_no in range(max_rounds):
        groups = max(1, math.ceil(n / partition_pieces))
        packed = materialise(_pack_dealt(todo, schema, groups, round_no, capacity, length), f"round{round_no}")
        totals = (
            packed.groupBy(F.shiftright("sequence_id", 24).alias("g"))
            .agg(F.max("bins").alias("bins"), F.max("bound").alias("bound"))
            .agg(F.count(F.lit(1)).alias("groups"), F.sum("bins").alias("bins"), F.sum(F.when(F.col("bins") == F.col("bound"), 1).otherwise(0)).alias("certified"))
            .first()
        )
        bins = totals["bins"] or 0
        rounds.append({"partitions": totals["groups"], "certified": totals["certified"] or 0, "sequences": bins, "pieces": n})
        if best is not None and bins >= best[1]:
            break  # nothing saved: the open sequences of the round before stay
        best = (packed, bins)
        if closed_bins + bins <= bound or totals["groups"] <= 1:
            break
        last = _emptiest(packed, capacity, closed_bins + bins - bound, partition_pieces)
        done.append(packed.filter(F.col("fill") > last))
        open_rows = packed.filter(F.col("fill") <= last)
        left = open_rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("offset") == 0).alias("bins")).first()
        closed_bins += bins - left["bins"]
        todo, n, best = open_rows.select(*pieces.columns, "_deal"), left["n"], (open_rows, left["bins"])
    result = best[0]
    for part in done:
        result = result.unionByName(part)
    used = closed_bins + best[1]
    certificate = {"sequences": used, "bound": bound, "certified": used == bound, "rounds": rounds}
    return result.select(*pieces.columns, "sequence_id", "offset"), certificate


def packed_documents(documents: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Every row of ``documents`` as pieces placed in sequences; see ``token_pieces`` and ``pack``."""
    keep = {k: options.pop(k) for k in ("partition_pieces", "max_rounds") if k in options}
    capacity = options.get("capacity", CAPACITY)
    return pack(token_pieces(documents, tokenizer, **options), capacity=capacity, **keep)[0]
