"""Repeated lines and sentences across documents, all but the first occurrence removed.

Texts are cut into units: lines, and within lines sentences. Units of at least
``min_words`` words are normalised and hashed to 128 bits. Digests are grouped
over all documents with partial aggregates, so a passage that a third of all
documents holds stays small before the shuffle; the occurrence of the smallest
rank (document, then offset) is kept and every other one is reported with its
offsets in the original text. Neighbouring repeats form a run; runs of few
words are left alone, as single boilerplate lines are the line dedup's work,
but not where the words around them make a long passage that is repeated.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellwatch.llm.frames import fresh, materialise

MIN_WORDS = 8
MIN_RUN_WORDS = 25
RUN_GAP = 80
_SENTENCE = re.compile(r"[.!?]+(?=\s|$)")
_WORD = re.compile(r"\w+")


def units(text: str | None, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, bytes]]:
    """Begin, end, words and digest of every unit; ends exclusive, in code points.

    Lines come with the sentences in them; a line of one sentence is one unit.
    Units are compared by their lower-cased words, so spacing, punctuation and
    case do not matter.
    """
    found = []
    at = 0
    for line in (text or "").split("\n"):
        # A line of fewer characters cannot hold so many words.
        if len(line) >= 2 * min_words - 1:
            cuts, begin = [], 0
            for m in _SENTENCE.finditer(line):
                cuts.append((begin, m.end()))
                begin = m.end()
            if begin < len(line):
                cuts.append((begin, len(line)))
            line_words: list[str] = []
            for a, b in cuts:
                words = _WORD.findall(line[a:b].lower())
                line_words += words
                if len(cuts) > 1 and len(words) >= min_words:
                    a += len(line[a:b]) - len(line[a:b].lstrip())
                    found.append((at + a, at + b, len(words), _digest(words)))
            if len(line_words) >= min_words:
                found.append((at, at + len(line), len(line_words), _digest(line_words)))
        at += len(line) + 1
    return found


def _digest(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _rows(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, begin, end, words, digest = [], [], [], [], []
        for i, text in enumerate(batch.column(2).to_pylist()):
            for a, b, n, d in units(text, min_words):
                row.append(i)
                begin.append(a)
                end.append(b)
                words.append(n)
                digest.append(d)
        pick = pa.array(row, pa.int64())
        h = np.frombuffer(b"".join(digest), dtype="<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pick),
                batch.column(1).take(pick),
                pa.array(begin, pa.int32()),
                pa.array(end, pa.int32()),
                pa.array(words, pa.int32()),
                pa.array(np.ascontiguousarray(h[:, 0])),
                pa.array(np.ascontiguousarray(h[:, 1])),
            ],
            names=["doc_id", "text_hash", "begin", "end", "n_words", "h1", "h2"],
        )


def _long_runs(spans: DataFrame, min_run_words: int, gap: int) -> DataFrame:
    """Spans in runs of enough words; spans of one text at most ``gap`` characters apart are one run.

    Spans nest but never cross, so the words of a run are those of its outer
    spans. The windows run within one text.
    """
    text = Window.partitionBy("doc_id", "text_hash").orderBy("begin", F.desc("end"))
    reach = F.max("end").over(text.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("_reach", reach).withColumns(
        {
            "_starts": F.when(F.col("_reach").isNull() | (F.col("begin") - F.col("_reach") > gap), 1).otherwise(0),
            "_own": F.when(F.col("_reach").isNull() | (F.col("end") > F.col("_reach")), F.col("n_words")).otherwise(0),
        }
    )
    runs = marked.withColumn("_run", F.sum("_starts").over(text))
    words = F.sum("_own").over(Window.partitionBy("doc_id", "text_hash", "_run"))
    return runs.withColumn("_words", words).filter(F.col("_words") >= min_run_words).select(spans.columns)


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Digests of all runs of ``size`` words around every span of a text; ``at`` is the first word's number."""
    for batch in batches:
        row, begin, end, at, digest = [], [], [], [], []
        for i, (text, cut) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            words: list[str] = []
            number, done = {}, 0
            # Spans end between words, so the words of the parts are those of the text.
            for p in [*sorted({p for s in cut for p in (s["begin"], s["end"])}), len(text)]:
                words += _WORD.findall(text[done:p].lower())
                number[p], done = len(words), p
            for s in cut:
                low, high = number[s["begin"]], number[s["end"]]
                for first in range(max(0, high - size), min(low, len(words) - size) + 1):
                    row.append(i)
                    begin.append(s["begin"])
                    end.append(s["end"])
                    at.append(first)
                    digest.append(_digest(words[first : first + size]))
        pick = pa.array(row, pa.int64())
        h = np.frombuffer(b"".join(digest), dtype="<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pick),
                batch.column(1).take(pick),
                pa.array(begin, pa.int32()),
                pa.array(end, pa.int32()),
                pa.array(at, pa.int32()),
                pa.array(np.ascontiguousarray(h[:, 0])),
                pa.array(np.ascontiguousarray(h[:, 1])),
            ],
            names=["doc_id", "text_hash", "begin", "end", "at", "w1", "w2"],
        )


def _in_passages(rows: DataFrame, spans: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, begin and end of the spans inside ``size`` words in a row that occur earlier as well."""
    cut = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("begin", "end")).alias("cut"))
    cut = materialise(cut.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"), "cut"), "cut")
    whole = rows.join(cut, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("h")))
    found = whole.select("doc_id", "text_hash", "text", "cut").mapInArrow(
        lambda batches: _windows(batches, size), "doc_id long, text_hash long, begin int, end int, at int, w1 long, w2 long"
    )
    found = materialise(found, "windows")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "at")
    first = found.groupBy("w1", "w2").agg(F.min(rank).alias("first"), F.max(rank).alias("last")).filter("first <> last")
    later = found.join(materialise(first.drop("last"), "passages"), ["w1", "w2"]).filter(rank != F.col("first"))
    return later.select("doc_id", "text_hash", "begin", "end").distinct()


def repeated_units(
    documents: DataFrame,
    *,
    min_words: int = MIN_WORDS,
    min_run_words: int = MIN_RUN_WORDS,
    run_gap: int = RUN_GAP,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every occurrence of a unit but the first: the spans to remove.

    Columns: doc_id, text_hash, begin, end (code points of the original text),
    n_words, digest (hex), kept_doc_id and kept_begin of the first occurrence,
    and n_occurrences. Occurrences are ranked by document id (nulls last), text
    hash and begin, so repeats inside one text go as well. Runs of repeats of
    fewer than ``min_run_words`` words are left out, unless the unit lies inside
    that many words in a row that occur earlier as well, whatever their sentences. Rows that are equal
    in id and text are one document. Null, empty and short texts have no units.
    An empty table gives no rows. Other columns are not read.
    """
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    ).filter(F.length("text") > 0)
    found = materialise(
        rows.mapInArrow(
            lambda batches: _rows(batches, min_words),
            "doc_id long, text_hash long, begin int, end int, n_words int, h1 long, h2 long",
        ),
        "units",
    )
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "begin")
    groups = (
        found.groupBy("h1", "h2")
        .agg(F.min(rank).alias("first"), F.max(rank).alias("last"), F.count(F.lit(1)).alias("n_occurrences"))
        .filter(F.col("first") != F.col("last"))
        .drop("last")
    )
    groups = materialise(groups, "repeats")
    # Written before the next step, so that this join can be split where a unit is very frequent.
    repeats = materialise(found.join(groups, ["h1", "h2"]).filter(rank != F.col("first")), "occurrences")
    repeats = repeats.distinct()
    kept = materialise(_long_runs(repeats, min_run_words, run_gap), "runs")
    place = ["doc_id", "text_hash", "begin", "end"]
    # What stands in a short run may still be part of a long passage whose other sentences differ at an end.
    same = F.lit(True)
    for c in place:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}"))
    short = materialise(repeats.alias("r").join(kept.select(place).alias("k"), same, "left_anti"), "short")
    alike = found.join(short.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").filter(F.col("n_words") < min_run_words)
    passages = materialise(_in_passages(rows, alike, min_run_words), "in_passages")
    more = short.alias("r").join(passages.alias("k"), same, "left_semi")
    return (
        kept.unionByName(more)
        .select(
            "doc_id",
            "text_hash",
            F.col("begin").cast("long").alias("begin"),
            F.col("end").cast("long").alias("end"),
            F.col("n_words").cast("long").alias("n_words"),
            F.concat(F.lpad(F.lower(F.hex("h1")), 16, "0"), F.lpad(F.lower(F.hex("h2")), 16, "0")).alias("digest"),
            F.col("first.doc_id").alias("kept_doc_id"),
            F.col("first.begin").cast("long").alias("kept_begin"),
            "n_occurrences",
        )
    )


def without_spans(documents: DataFrame, spans: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with ``kept_spans``, the original offsets of what stays, and ``kept_text``.

    ``spans`` come from ``repeated_units``; overlapping ones are merged. Names
    that the input has already get underscores.
    """
    per_row = (
        spans.groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("_cut"))
        .select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "_cut")
    )
    joined = documents.join(
        per_row, documents[doc_id].cast("long").eqNullSafe(per_row["_doc"]) & (F.xxhash64(documents[text]) == per_row["_hash"]), "left"
    )
    size = F.char_length(F.coalesce(documents[text], F.lit(""))).cast("long")
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("kept"))

    def step(acc, cut):
        gap = F.struct(acc["at"].alias("begin"), cut["begin"].alias("end"))
        return F.struct(
            F.greatest(acc["at"], cut["end"]).alias("at"),
            F.when(cut["begin"] > acc["at"], F.concat(acc["kept"], F.array(gap))).otherwise(acc["kept"]).alias("kept"),
        )

    end = F.struct(size.alias("begin"), size.alias("end"))
    cuts = F.concat(F.coalesce("_cut", F.array().cast("array<struct<begin:bigint,end:bigint>>")), F.array(end))
    spans_name, text_name = fresh(documents, "kept_spans"), fresh(documents, "kept_text")
    kept = joined.select(
        *[documents[c] for c in documents.columns], F.aggregate(cuts, state, step, lambda s: s["kept"]).alias(spans_name)
    )
    pieces = F.transform(
        F.col(spans_name),
        lambda s: F.substring(documents[text], (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int")),
    )
    return kept.select("*", F.array_join(pieces, "").alias(text_name))
