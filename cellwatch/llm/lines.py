"""Lines that many documents share, dropped everywhere.

Lines are normalised, hashed to 128 bits and exploded; the documents per hash
are counted with partial sums before the shuffle; positions of the frequent
lines go back to their documents, which are put together again by position.
A line that a third of all rows holds is one row per document until its count,
and its join side is split like any skewed join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.frames import fresh, materialise

MIN_CHARS = 1
MIN_DOCUMENTS = 10


def line_key(line: str) -> str:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    # On bytes, strip and lower are exactly that.
    return line.encode("utf-8", "surrogatepass").strip().lower().decode("utf-8", "surrogatepass")


def _digests(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, digest, places = [], [], []
        for i, text in enumerate(batch.column(2).to_pylist()):
            seen: dict[bytes, list[int]] = {}
            for at, line in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")):
                key = line.strip().lower()
                if min_chars <= 1 and key or min_chars > 1 and len(key.decode("utf-8", "replace")) >= min_chars or min_chars < 1:
                    seen.setdefault(hashlib.blake2b(key, digest_size=16).digest(), []).append(at)
            row += [i] * len(seen)
            digest += seen
            places += seen.values()
        h = np.frombuffer(b"".join(digest), dtype="<i8").reshape(-1, 2)
        pick = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pick),
                batch.column(1).take(pick),
                pa.array(np.ascontiguousarray(h[:, 0])),
                pa.array(np.ascontiguousarray(h[:, 1])),
                pa.array(places, pa.list_(pa.int32())),
            ],
            names=["doc_id", "text_hash", "h1", "h2", "places"],
        )


def _kept_lines(lines: Column, dropped: Column) -> Column:
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    return F.array_join(F.transform(F.array_except(every, dropped), lambda i: F.get(lines, i)), "\n")


def drop_common_lines(
    documents: DataFrame,
    *,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    doc_id: str = "doc_id",
    text: str = "text",
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
    kept: str = "kept_text",
) -> DataFrame:
    """``documents`` with every row's line count, dropped lines and kept text.

    A line's key has no ASCII white space at its ends and A-Z in lower case.
    Keys of at least ``min_chars`` code points that at least ``min_documents``
    rows hold lose all their lines in every row. Every row is a document, also
    a repeated one or one with a null id. Null and empty texts are one empty
    line and keep an empty text. Names of the three new columns that the input
    has already get underscores. An empty table gives an empty table.
    """
    ids = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    id_type = ids.schema["doc_id"].dataType.simpleString()
    keyed = materialise(
        ids.filter(F.length("text") > 0).mapInArrow(
            lambda batches: _digests(batches, min_chars),
            f"doc_id {id_type}, text_hash long, h1 long, h2 long, places array<int>",
        ),
        "lines",
    )
    common = keyed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_documents).select("h1", "h2")
    # Written, so that the join has two plain sides and a line that very many rows hold can be split.
    common = materialise(common, "common")
    # Rows of one id and text lose the same lines, so one list serves them all.
    lists = (
        keyed.join(common, ["h1", "h2"])
        .groupBy("doc_id", "text_hash")
        .agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("_places"))
        .select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "_places")
    )
    lists = materialise(lists, "dropped")
    out = documents.join(
        lists, documents[doc_id].eqNullSafe(lists["_doc"]) & (F.xxhash64(documents[text]) == lists["_hash"]), "left"
    )
    split = out.withColumn("_lines", F.split(F.coalesce(documents[text], F.lit("")), "\n", -1))
    none = F.col("_places").isNull()
    return split.select(
        *[documents[c] for c in documents.columns],
        F.size("_lines").cast("long").alias(fresh(documents, n_lines)),
        F.when(none, F.lit(0)).otherwise(F.size("_places")).cast("long").alias(fresh(documents, n_dropped)),
        F.when(none, F.coalesce(documents[text], F.lit(""))).otherwise(_kept_lines(F.col("_lines"), F.col("_places"))).alias(fresh(documents, kept)),
    )
