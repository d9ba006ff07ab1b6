"""Quality scores from naive Bayes support vectors.

A text becomes a set of hashed n-grams: its words, pairs of neighbouring words,
runs of one repeated word, and runs of three bytes. Presence is all that
counts. Every n-gram is scaled by its class log-count ratio, and a linear
hinge-loss model is fitted to the scaled indicators by dual coordinate
descent; a sigmoid fitted to held-back margins turns margins into scores.

The model is fitted on all n-grams of all labelled texts. While they are few the
descent runs over them in one piece. Beyond ``LOCAL_NGRAMS`` they are written in
blocks, and every block descends on its own from the common weights, all blocks at
once (CoCoA: Jaggi et al. 2014, with added updates as Ma et al. 2015); the updates
are summed in Spark, so the driver receives sums of fixed size. Scoring runs over
whole texts in Arrow batches; the weights are one array of fixed size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellwatch.llm.frames import materialise
from cellwatch.session import scratch_path

BUCKETS = 1 << 18
# Bounds that a caller can set.
MAX_NGRAMS = 1 << 25
# Four bytes each on their way to the driver, twelve in the fit.
LOCAL_NGRAMS = 1 << 22
BLOCK_NGRAMS = 1 << 23
BROADCAST_IDS = 1_000_000
# Rounds end early when the objective is proved to be that close to the least one.
ROUNDS, EPOCHS, GAP = 6, 4, 0.01
_WINDOW = 1 << 20


def ngrams(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Sorted distinct hashed n-grams of a whole text; none for null and empty texts."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return np.empty(0, np.int64)
    words = raw.split()
    found = {zlib.crc32(w) for w in set(words)}
    found.update(zlib.crc32(b" ".join(p)) for p in set(zip(words, words[1:])))
    run = 1
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 1
        if run > 1:
            found.add(zlib.crc32(b"\n%d" % min(run, 8)))
    parts = [np.fromiter(found, np.int64, len(found)) % buckets]
    codes = np.frombuffer(raw, np.uint8)
    # Overlapping windows, so memory stays bounded however long the text is.
    for i in range(0, max(1, len(codes) - 2), _WINDOW):
        c = codes[i : i + _WINDOW + 2].astype(np.uint32)
        if len(c) > 2:
            three = np.unique(c[:-2] | c[1:-1] << 8 | c[2:] << 16).astype(np.uint64)
            parts.append(((three * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % buckets)
    return np.unique(np.concatenate(parts))


@dataclass(frozen=True)
class Model:
    """Weights of the n-grams (ratios times hinge weights), and the sigmoid of the margin."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, features: np.ndarray) -> float:
        if not len(features):
            return self.bias
        return float(self.weights[features].sum() / np.sqrt(len(features)) + self.bias)

    def probability(self, margin: np.ndarray | float):
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray, buckets: int, smoothing: float = 1.0) -> np.ndarray:
    counts = np.full((2, buckets), smoothing)
    for f, y in zip(rows, good):
        counts[int(y), f] += 1
    totals = counts.sum(axis=1, keepdims=True)
    shares = counts / totals
    return np.log(shares[1] / shares[0])


def _descend(
    rows: list[tuple[np.ndarray, np.ndarray]],
    signs: np.ndarray,
    costs: np.ndarray,
    w: np.ndarray,
    bias: float,
    alpha: np.ndarray,
    seed: int,
    epochs: int,
    parts: int = 1,
) -> float:
    """Up to ``epochs`` passes of coordinate steps, in place of ``w`` and ``alpha``; gives the bias.

    With ``parts`` blocks descending at once every step moves ``w`` that many times
    as far, as if the others took it too.
    """
    norms = np.array([parts * (float(v @ v) + 1.0) for _, v in rows])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(rows)):
            idx, val = rows[i]
            gradient = signs[i] * (float(w[idx] @ val) + bias) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), costs[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                w[idx] += parts * step * val
                bias += parts * step
                worst = max(worst, abs(step))
                alpha[i] = new
        if worst < 1e-3:
            break
    return bias


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, dims: int, costs: np.ndarray, epochs: int = 12, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss; each row is (indices, values)."""
    w = np.zeros(dims)
    return w, _descend(rows, signs, costs, w, 0.0, np.zeros(len(rows)), seed, epochs)


def _sigmoid_of(margins: np.ndarray, good: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve over the margins, by Newton steps."""
    a, b = 1.0, 0.0
    # Targets a little inside 0 and 1, so that separable margins have a finite best curve.
    y = np.where(good, 1 - 1 / (good.sum() + 2), 1 / ((~good).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = weights * (p - y)
        h = weights * p * (1 - p) + 1e-9
        gradient = np.array([g @ margins, g.sum()])
        hessian = np.array([[h @ (margins * margins) + 1e-6, h @ margins], [h @ margins, h.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def _constant(share_good: float, buckets: int) -> Model:
    p = min(max(share_good, 1e-3), 1 - 1e-3)
    return Model(np.zeros(buckets, np.float32), 0.0, 1.0, float(np.log(p / (1 - p))))


def fit(rows: list[np.ndarray], good: np.ndarray, share_good: float, *, buckets: int = BUCKETS, cost: float = 1.0) -> Model:
    """Fit on n-gram rows and their classes; ``share_good`` is the share of class 1 among all labels.

    With one class only, or no row at all, every score is that share.
    """
    good = np.asarray(good, bool)
    if good.all() or not good.any():
        return _constant(share_good, buckets)
    prior = np.where(good, share_good / good.mean(), (1 - share_good) / (1 - good.mean()))
    held = np.arange(len(rows)) % 5 == 4
    if not (good[held].any() and (~good[held]).any() and good[~held].any() and (~good[~held]).any()):
        held[:] = False

    def train(pick: np.ndarray) -> tuple[np.ndarray, float]:
        chosen = [rows[i] for i in np.flatnonzero(pick)]
        ratios = log_count_ratios(chosen, good[pick], buckets)
        scaled = [(f, ratios[f] / np.sqrt(max(1, len(f)))) for f in chosen]
        signs = np.where(good[pick], 1.0, -1.0)
        w, bias = dual_coordinate_descent(scaled, signs, buckets, cost * prior[pick])
        return ratios * w, bias

    def margins(w: np.ndarray, bias: float, pick: np.ndarray) -> np.ndarray:
        m = Model(w, bias, 1.0, 0.0)
        return np.array([m.margin(rows[i]) for i in np.flatnonzero(pick)])

    judged = held if held.any() else np.ones(len(rows), bool)
    slope, shift = _sigmoid_of(margins(*train(~held), judged), good[judged], prior[judged])
    w, bias = train(np.ones(len(rows), bool))
    return Model(w.astype(np.float32), float(bias), slope, shift)


def _packed(grams: np.ndarray) -> bytes:
    """Sorted n-grams as the steps between them, two bytes each or four where one is large."""
    steps = np.diff(grams, prepend=0)
    wide = len(steps) > 0 and steps.max() >= 1 << 16
    return (b"4" if wide else b"2") + steps.astype("<u4" if wide else "<u2").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<u4" if raw[:1] == b"4" else "<u2", offset=1), dtype=np.int64)


def _blocks(found: DataFrame, number: int) -> DataFrame:
    """One row per block of whole rows, a file each; equal n-grams of one id count once."""

    def block(table: pa.Table) -> pa.Table:
        rows = sorted(set(zip(table["i"].to_pylist(), table["f"].to_pylist(), table["y"].to_pylist())))
        order = np.random.default_rng(5).permutation(len(rows))
        y, f = [rows[k][2] for k in order], [rows[k][1] for k in order]
        held = (np.arange(len(rows)) % 5 == 4).tolist()
        return pa.table(
            {
                "block": pa.array([table["block"][0].as_py()], pa.int32()),
                "y": pa.array([y], pa.list_(pa.int32())),
                "held": pa.array([held], pa.list_(pa.bool_())),
                "f": pa.array([f], pa.list_(pa.binary())),
            }
        )

    dealt = found.select("i", "y", "f", F.pmod(F.xxhash64("i", "f"), F.lit(number)).cast("int").alias("block"))
    packed = dealt.groupBy("block").applyInArrow(block, "block int, y array<int>, held array<boolean>, f array<binary>")
    path = scratch_path(found.sparkSession, "fit-blocks")
    packed.write.option("maxRecordsPerFile", 1).parquet(path)
    return found.sparkSession.read.schema(packed.schema).parquet(path)


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray, bytes | None]]:
    """Number, n-grams, classes, held marks and stored steps of each block of a batch."""
    for k in range(batch.num_rows):
        row = {name: batch.column(name)[k] for name in batch.schema.names}
        grams = [_unpacked(f) for f in row["f"].as_py()]
        alpha = row["alpha"].as_py() if "alpha" in row else None
        yield row["block"].as_py(), grams, np.array(row["y"].as_py()) == 1, np.array(row["held"].as_py(), bool), alpha


def _summed(sums: DataFrame, size: int) -> np.ndarray:
    """The sums of ``v`` by ``place``, 0 to ``size`` - 1, as one array."""
    table = sums.groupBy("place").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[table["place"].to_numpy()] = table["v"].to_numpy()
    return out


def _sums(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["place", "v"])


def _train_blocks(blocks: DataFrame, number: int, buckets: int, costs: tuple[float, float], whole: bool) -> tuple[np.ndarray, float]:
    """Weights (ratios times hinge weights) and bias from all rows, or from those not held out."""
    spark = blocks.sparkSession

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * buckets)
        for batch in batches:
            for _, grams, good, held, _ in _rows_of(batch):
                for f, y, out in zip(grams, good, held):
                    if whole or not out:
                        total[f + buckets * int(y)] += 1
        yield _sums(total)

    counts = 1.0 + _summed(blocks.mapInArrow(counted, "place long, v double"), 2 * buckets).reshape(2, buckets)
    shares = counts / counts.sum(axis=1, keepdims=True)
    ratios = np.log(shares[1] / shares[0])

    # After the weights: the bias, the sum of the losses at the start of a round, and that of the steps.
    at_bias, at_loss, at_alpha = buckets, buckets + 1, buckets + 2
    w, bias, stored, kept = np.zeros(buckets), 0.0, None, None
    for number_of_round in range(ROUNDS):
        sent = spark.sparkContext.broadcast((ratios, w, bias))

        def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ratios, start, start_bias = sent.value
            total = np.zeros(buckets + 3)
            for batch in batches:
                for block, grams, good, held, alpha in _rows_of(batch):
                    pick = np.flatnonzero(np.ones(len(good), bool) if whole else ~held)
                    rows = [(grams[i], ratios[grams[i]] / np.sqrt(max(1, len(grams[i])))) for i in pick]
                    signs, bound = np.where(good[pick], 1.0, -1.0), np.where(good[pick], costs[1], costs[0])
                    alpha = np.zeros(len(rows)) if alpha is None else np.frombuffer(alpha).copy()
                    margins = np.array([float(start[f] @ v) for f, v in rows]) + start_bias
                    total[at_loss] += bound @ np.maximum(0.0, 1.0 - signs * margins)
                    total[at_alpha] += alpha.sum()
                    moved = start.copy()
                    end = _descend(rows, signs, bound, moved, start_bias, alpha, 7 + number_of_round, EPOCHS, number)
                    total[:buckets] += (moved - start) / number
                    total[at_bias] += (end - start_bias) / number
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()), pa.array([block], pa.int32()), pa.array([alpha.tobytes()])],
                        names=["place", "v", "block", "alpha"],
                    )
            sums = _sums(total)
            n = sums.num_rows
            yield pa.RecordBatch.from_arrays([*sums.columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=["place", "v", "block", "alpha"])

        # Eight bytes a row, so this side is sent.
        given = blocks if stored is None else blocks.join(F.broadcast(stored), "block")
        out = given.mapInArrow(descend, "place long, v double, block int, alpha binary").persist()
        sums = _summed(out.filter("block is null").select("place", "v"), buckets + 3)
        sent.unpersist()
        if kept is not None:
            kept.unpersist()
        kept, stored = out, out.filter("block is not null").select("block", "alpha")
        norm = float(w @ w) + bias * bias
        least, most = sums[at_alpha] - norm / 2, sums[at_loss] + norm / 2
        if most - least <= GAP * most:
            break
        w, bias = w + sums[:buckets], bias + float(sums[at_bias])
    kept.unpersist()
    return ratios * w, bias


def _sigmoid_of_table(margins: DataFrame, n: dict[bool, int], weight: tuple[float, float]) -> tuple[float, float]:
    """``_sigmoid_of`` with its sums taken in Spark; ``margins`` has m and good."""
    a, b = 1.0, 0.0
    good, m = F.col("good"), F.col("m")
    y = F.when(good, 1 - 1 / (n[True] + 2)).otherwise(1 / (n[False] + 2))
    c = F.when(good, weight[1]).otherwise(weight[0])
    for _ in range(50):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), a * m + b))))
        g, h = c * (p - y), c * p * (1 - p) + 1e-9
        r = margins.agg(*[F.sum(x) for x in (g * m, g, h * m * m, h * m, h)]).first()
        step = np.linalg.solve(np.array([[r[2] + 1e-6, r[3]], [r[3], r[4] + 1e-6]]), np.array([r[0], r[1]]))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def fit_in_blocks(found: DataFrame, share_good: float, *, number: int, buckets: int = BUCKETS, cost: float = 1.0) -> Model:
    """``fit`` on the rows i, y and f (packed n-grams) of a table, in ``number`` blocks at once."""
    blocks = _blocks(found, number)
    each = blocks.select(F.explode(F.arrays_zip("y", "held")).alias("r")).groupBy("r.y", "r.held").count().collect()
    n = {(r["y"] == 1, r["held"]): r["count"] for r in each}
    of = {y: n.get((y, False), 0) + n.get((y, True), 0) for y in (False, True)}
    if not of[True] or not of[False]:
        return _constant(share_good, buckets)
    mean = of[True] / (of[True] + of[False])
    prior = ((1 - share_good) / (1 - mean), share_good / mean)
    costs = (cost * prior[0], cost * prior[1])
    split = all(n.get((y, h)) for y in (False, True) for h in (False, True))
    weights, bias = _train_blocks(blocks, number, buckets, costs, not split)
    sent = blocks.sparkSession.sparkContext.broadcast(Model(weights, bias, 1.0, 0.0))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, grams, good, held, _ in _rows_of(batch):
                pick = np.flatnonzero(held) if split else np.arange(len(good))
                m = [sent.value.margin(grams[i]) for i in pick]
                yield pa.RecordBatch.from_arrays([pa.array(m, pa.float64()), pa.array(good[pick], pa.bool_())], names=["m", "good"])

    margins = materialise(blocks.mapInArrow(judged, "m double, good boolean"), "fit-margins")
    slope, shift = _sigmoid_of_table(margins, {y: n[y, True] if split else of[y] for y in (False, True)}, prior)
    if split:
        weights, bias = _train_blocks(blocks, number, buckets, costs, True)
    return Model(weights.astype(np.float32), bias, slope, shift)


def is_held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3; null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(
    documents: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    max_rows: int | None = None,
    max_ngrams: int | None = None,
    local_ngrams: int = LOCAL_NGRAMS,
    block_ngrams: int = BLOCK_NGRAMS,
    buckets: int = BUCKETS,
) -> Model:
    """Fit on all rows with a labelled id that is not held out.

    Up to ``local_ngrams`` n-grams are fitted in one piece, more in blocks of about
    ``block_ngrams`` (``fit_in_blocks``). Rows of one id with equal n-grams count
    once. A document with several labels counts with the smallest one; null ids and
    null labels are left out; null and empty texts have no n-grams. No column but
    id, text and the label is read.

    ``max_rows`` and ``max_ngrams`` bound the fit where a caller asks for it, by
    ids per class and by n-grams of both classes. Ids are picked by the smallest
    hash within a class, so the pick does not depend on order. Each class takes
    ids in that order while all n-grams of its texts fit in half of
    ``max_ngrams``: texts are fitted whole or not at all. An id whose rows alone
    fill more than a sixteenth of that half (distinct texts under one id) is passed
    over; where a class has only such ids, the first is taken if it fits in the
    half, else the class counts as missing.
    """
    known = (
        labels.select(F.col(label_id).cast("long").alias("i"), F.col(label).cast("int").alias("y"))
        .filter("i is not null and y in (0, 1)")
        .filter(~is_held_out(F.col("i")))
        .groupBy("i")
        .agg(F.min("y").alias("y"))
    )
    shares = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    total = sum(shares.values())
    share = shares.get(1, 0) / total if total else 0.5
    order = F.xxhash64(F.lit("fit"), "i")
    if max_rows is not None:
        one, two = (known.filter(F.col("y") == y).orderBy(order, "i").limit(max_rows) for y in (0, 1))
        known = one.unionByName(two)
    known = materialise(known, "fit-ids")
    # Two numbers an id; texts are shuffled only to meet more ids than that.
    sent = F.broadcast(known) if total <= BROADCAST_IDS else known
    rows = documents.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t")).join(sent, "i")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngrams(t, buckets) for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("i"),
                    batch.column("y"),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([_packed(f) for f in found], pa.binary()),
                ],
                names=["i", "y", "n", "f"],
            )

    found = rows.select("i", "y", "t").mapInArrow(features, "i long, y int, n long, f binary")
    found = materialise(found, "fit-rows")
    if max_ngrams is not None:
        found = _within(found.distinct(), max_ngrams, order)
    size = found.agg(F.sum(F.col("n") + 1)).first()[0] or 0
    if size > local_ngrams:
        return fit_in_blocks(found, share, number=-(-size // block_ngrams), buckets=buckets)
    sample = [(r["i"], _unpacked(r["f"]).astype("<i4"), r["y"]) for r in found.distinct().collect()]
    sample.sort(key=lambda r: (r[0], r[1].tobytes()))
    shuffled = np.random.default_rng(5).permutation(len(sample))
    return fit([sample[k][1] for k in shuffled], np.array([sample[k][2] == 1 for k in shuffled], bool), share, buckets=buckets)


def _within(found: DataFrame, max_ngrams: int, order: Column) -> DataFrame:
    """The rows of the ids that fit in the bound; see ``learn``."""
    sizes = found.groupBy("i", "y").agg(F.sum(F.col("n") + 1).alias("size"))
    half = max_ngrams / 2
    by_hash = Window.partitionBy("y").orderBy("large", order, "i")
    taken = sizes.withColumn("large", F.col("size") > half / 16).withColumns(
        {"first": F.row_number().over(by_hash) == 1, "total": F.sum("size").over(by_hash)}
    )
    fitting = taken.filter("NOT large AND total <= %d OR first AND size <= %d" % (half, half)).select("i")
    return found.join(fitting, "i", "left_semi")


def scorer(spark, model: Model, buckets: int = BUCKETS):
    """Function from a text column to its score, 0 to 1; the weights are sent once per executor."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([float(m.probability(m.margin(ngrams(t, buckets)))) for t in texts], dtype="float64")

    return score


def scored(documents: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row; null texts score as empty ones.

    Repeated rows and null ids are rows like any other; an empty table gives none.
    """
    score = scorer(documents.sparkSession, model)
    return documents.select(
        F.col(doc_id).alias("doc_id"), is_held_out(F.col(doc_id)).alias("held_out"), score(F.col(text)).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
